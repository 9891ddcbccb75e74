"""Byte-pair ids of whole text columns, from the vocabulary file of a public byte-level tokenizer.

The file's own library is several times slower than ``tiktoken``, which takes the same merges as ranks; both split text by the same
pattern and give the same ids for every code point (tested). The file's library is used where a text holds a special token's string
that is to become that token.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

import numpy as np

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the split that the vocabulary's merges were counted with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _letters() -> dict[str, int]:
    """The vocabulary's letter of each byte: printable bytes stand for themselves, the others for 256 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """A vocabulary, read from the file's text so that it can be sent to executors; the encoders are built where they are used."""

    def __init__(self, file_text: str):
        self.file_text = file_text
        self._fast = self._own = None
        parsed = json.loads(file_text)
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        letters, vocabulary = _letters(), parsed["model"]["vocab"]
        self.ranks = {bytes(letters[c] for c in entry): i for entry, i in vocabulary.items() if entry not in self.special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
        if [vocabulary["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the ids of this vocabulary do not follow its merges")
        self.sizes = np.zeros(1 + max([*self.ranks.values(), *self.special.values()]), np.int64)
        self.sizes[list(self.ranks.values())] = [len(b) for b in self.ranks]

    def __reduce__(self):
        return BytePairs, (self.file_text,)

    def plain(self, text: str) -> np.ndarray:
        """Ids where strings of special tokens are plain text."""
        if self._fast is None:
            import tiktoken

            self._fast = tiktoken.Encoding("labmeter", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        return self._fast.encode_to_numpy(text, disallowed_special=())

    def marked(self, text: str) -> np.ndarray:
        """Ids where strings of special tokens are these tokens."""
        if not any(s in text for s in self.special):
            return self.plain(text)
        if self._own is None:
            import tokenizers

            self._own = tokenizers.Tokenizer.from_str(self.file_text)
        return np.array(self._own.encode(text, add_special_tokens=False).ids, np.uint32)


def read(path: str = MODEL) -> BytePairs:
    """Reads a vocabulary on the driver (it is of fixed size)."""
    return BytePairs(Path(path).read_text())


def joined(parts: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if len(parts) else np.zeros(0, np.uint32)
