"""Token counts by a public byte-pair tokenizer, whose rank file is a parameter."""

from __future__ import annotations

import base64
import re

#: where the rank file lies on every executor
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank file.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: distinct blank-separated strings whose counts a worker keeps
KEPT = 400_000

_ODD_BLANKS = re.compile(r"  |[^\S \n\r\t]")
_LOADED: dict[str, "Tokenizer"] = {}


class _Counts(dict):
    """Counts of strings that stand after a blank; they do not depend on their neighbours."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> int:
        n = len(self.encode(" " + part))
        if len(self) >= KEPT:
            self.clear()
        self[part] = n
        return n


class Tokenizer:
    def __init__(self, path: str = TOKENIZER):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("public", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = self.encoding.encode_ordinary
        self._counts = _Counts(self.encode)

    def count(self, text: str | None) -> int:
        """Tokens of the whole text. Single blanks only ever begin a split, so the parts between
        them are counted apart and repeated ones looked up; other texts are encoded as they are."""
        if not text:
            return 0
        if _ODD_BLANKS.search(text):
            return len(self.encode(text))
        first, *rest = text.split(" ")
        return len(self.encode(first)) + sum(map(self._counts.__getitem__, rest))


def tokenizer(path: str = TOKENIZER) -> Tokenizer:
    """One per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]
