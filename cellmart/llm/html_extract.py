"""Main text of web pages: a tree-structured graphical model over the elements of each page."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col
from cellmart.llm.html_tree import Tree, parse
from cellmart.llm.labelled_pages import labelled_pages

# pages with their own article markup that the model is fitted on besides the labelled ones
TRAIN_PAGES = 2000
SMOOTHING = 0.5
# a labelled page of this package counts as so many
LABELLED_WEIGHT = 8
# elements that say what they hold: these label the pages of the table
_MAIN = ("article", "main")
_OTHER = ("nav", "aside", "footer", "form", "menu", "dialog")


def features(tree: Tree) -> list[list[str]]:
    """Per element: its class words, and one feature of its tag, the bin of its own text's length and that of the links in it.

    Tag and bins go together, since length and links of a text depend on each other and count once.
    """
    out = []
    for node in tree.nodes:
        kind = f"tag={node.tag}"
        if node.chars:
            kind += f" links={round(2 * node.linked / node.chars)} chars={min(int(math.log2(node.chars)) // 2, 4)}"
        out.append([kind, *(f"word={w}" for w in node.words)])
    return out


def _coarser(kind: str) -> list[str]:
    """A feature of tag, links and length, and what is left of it without length and without both."""
    parts = kind.split(" ")
    return [" ".join(parts[:n]) for n in range(len(parts), 0, -1)]


@dataclass
class Model:
    """Counts of labels, of features by label, and of child labels by parent label."""

    label: Counter = field(default_factory=Counter)
    feature: Counter = field(default_factory=Counter)
    step: Counter = field(default_factory=Counter)

    def learn(self, tree: Tree, labels: Sequence[int], weight: int = 1) -> None:
        for node, found, own in zip(tree.nodes, features(tree), labels, strict=True):
            self.label[own] += weight
            for f in (*_coarser(found[0]), *found[1:]):
                self.feature[f, own] += weight
            if node.parent >= 0:
                self.step[labels[node.parent], own] += weight

    def evidence(self, found: Sequence[str]) -> float:
        """Log odds of main text from an element's features; what was never seen says nothing, a text of unseen length what its tag and links say."""
        out = 0.0
        known = next((f for f in _coarser(found[0]) if self.feature[f, 0] or self.feature[f, 1]), None)
        for f in (known, *found[1:]):
            a, b = self.feature[f, 1], self.feature[f, 0]
            if a or b:
                out += math.log((a + SMOOTHING) / (self.label[1] + 2 * SMOOTHING)) - math.log((b + SMOOTHING) / (self.label[0] + 2 * SMOOTHING))
        return out

    def transition(self, a: int, b: int) -> float:
        return (self.step[a, b] + SMOOTHING) / (self.step[a, 0] + self.step[a, 1] + 2 * SMOOTHING)


def marginals(parents: Sequence[int], local: Sequence[tuple[float, float]], table: Sequence[Sequence[float]]) -> list[float]:
    """P(label 1) of every node of a tree by sum-product messages, upward from the leaves and downward from the root.

    ``parents`` come before their children; ``local`` are the nodes' own potentials, ``table[a][b]`` that of a child's
    label b under a parent's a. Messages are scaled, so long trees do not underflow.
    """
    n = len(parents)
    up = [list(x) for x in local]  # own potential times messages from the children
    sent = [[1.0, 1.0] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        a = table[0][0] * up[i][0] + table[0][1] * up[i][1]
        b = table[1][0] * up[i][0] + table[1][1] * up[i][1]
        sent[i] = [a / (a + b), b / (a + b)]
        above = up[parents[i]]
        above[0] *= sent[i][0]
        above[1] *= sent[i][1]
        whole = above[0] + above[1]
        above[0] /= whole
        above[1] /= whole
    belief = [[0.0, 0.0] for _ in range(n)]
    for i in range(n):
        if not i:
            a, b = up[0]
        else:
            # what the parent believes without this child
            x, y = belief[parents[i]][0] / sent[i][0], belief[parents[i]][1] / sent[i][1]
            a = up[i][0] * (table[0][0] * x + table[1][0] * y)
            b = up[i][1] * (table[0][1] * x + table[1][1] * y)
        belief[i] = [a / (a + b), b / (a + b)]
    return [b for _, b in belief]


def _labels(tree: Tree) -> list[int]:
    """Labels that a page's own markup states: 1 inside article or main but not in what is marked as something else."""
    out = [0]
    for node in tree.nodes[1:]:
        above = out[node.parent]
        out.append(1 if node.tag in _MAIN else 0 if node.tag in _OTHER else above)
    return out


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES, html: str = "html") -> Model:
    """Counts over the labelled pages of this package, and over at most about ``train_pages`` pages of the table that label themselves.

    Pages are chosen by a hash of their html, so reruns agree; a row per feature and label reaches the driver.
    """
    model = Model()
    for page, labels in labelled_pages():
        model.learn(parse(page), labels, LABELLED_WEIGHT)
    text = col(html)
    total = pages.count()
    share = min(1.0, train_pages / max(total, 1))
    # enough of the hash for any table
    chosen = pages.where(F.pmod(F.xxhash64(text), F.lit(1_000_003)) < F.lit(share * 1_000_003)).select(text.alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                tree = parse(value.as_py() or "")
                labels = _labels(tree)
                if 1 not in labels:
                    continue
                own = Model()
                own.learn(tree, labels)
                for kind in ("label", "feature", "step"):
                    for key, n in getattr(own, kind).items():
                        key = key if isinstance(key, tuple) else (key,)
                        counts[kind, *map(str, key)] += n
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys]), pa.array(["\t".join(k[1:]) for k in keys]), pa.array([counts[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays([columns[0].cast(pa.string()), columns[1].cast(pa.string()), columns[2]], ["kind", "key", "n"])

    summed = chosen.mapInArrow(run, "kind string, key string, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    # class words are open-ended: the rare ones say little
    for row in summed.where("n >= 5").collect():
        *name, last = row["key"].split("\t")
        key = int(last) if row["kind"] == "label" else (int(name[0]) if row["kind"] == "step" else name[0], int(last))
        getattr(model, row["kind"])[key] += row["n"]
    return model


def main_text(page: str | None, model: Model) -> str:
    """The page's main text: the texts of elements that are main text with a probability of a half or more.

    White space inside a block becomes one space, blocks are trimmed and joined by line feeds; nothing else is
    dropped. NULL and pages without such elements give an empty text.
    """
    tree = parse(page or "")
    table = [[model.transition(a, b) for b in (0, 1)] for a in (0, 1)]
    local = []
    for found in features(tree):
        odds = max(min(model.evidence(found), 30.0), -30.0)
        local.append((1 / (1 + math.exp(odds)), 1 / (1 + math.exp(-odds))))
    # the page itself is not main text
    local[0] = (1 - 1e-9, 1e-9)
    chance = marginals([n.parent for n in tree.nodes], local, table)
    blocks: list[list[str]] = []
    new = True
    for node, text, starts in tree.texts:
        new = new or starts
        if chance[node] < 0.5:
            continue
        if new:
            blocks.append([])
            new = False
        blocks[-1].append(text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``; whole pages are read.

    The model (see :func:`fit`) is broadcast: counts of tags, bins and class words seen five times or more. NULL pages and pages
    without main text have an empty text of 0 characters; equal pages get equal texts. An empty table
    gives an empty result. Other columns are not read.
    """
    model = fit(pages, html=html)
    parts = tuple(dict(x) for x in (model.label, model.feature, model.step))
    shared = pages.sparkSession.sparkContext.broadcast(parts)
    given = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(html).alias("html"))
    fields = [given.schema["page_id"], given.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*map(Counter, shared.value))
        for batch in batches:
            texts = [main_text(x.as_py(), model) for x in batch.column(2)]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return given.mapInArrow(run, schema)
