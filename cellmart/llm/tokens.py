"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import json
import re

import numpy as np

# fixed value: the vocabulary's pattern for pieces of text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# characters whose classes no Unicode version disputes: ASCII, Latin, kana, Han, Hangul and their signs
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ɏ、-〃ぁ-ゖァ-ヺ一-龥가-힣！-～]*")


def _bytes_of_signs() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: itself if printable, the others count up from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids as ``tokenizers`` gives them for the whole text, without special tokens added.

    That library needs over twice the CPU time there is for a corpus. Texts of plain characters are encoded with the
    same merges, read from the same file, by ``tiktoken``; texts with other characters, or with a special token spelled
    out, are left to ``tokenizers``. So is every text if a vocabulary's ids do not follow the order of its merges.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        self.special = [x["content"] for x in saved["added_tokens"]]
        self.fast = self._fast(saved["model"])

    def _fast(self, model: dict):
        import tiktoken

        special = set(self.special)
        signs = _bytes_of_signs()
        ids = {bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged) or len(ids) != 256 + len(merged):
            return None
        return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(x in text for x in self.special):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
