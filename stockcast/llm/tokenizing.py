"""Token ids by the public byte-level vocabulary. The vocabulary's path is a parameter; executors need the file there."""

from __future__ import annotations

import json
import re

import numpy as np

SPECIAL = "<|endoftext|>"
#: letters, marks and signs up to Latin Extended-B and general punctuation: here both libraries split text alike
_PLAIN = re.compile("[\x00-\u024f\u2000-\u206f]*").fullmatch
#: longer texts go to the tokenizers library, whose splitter has no limit on one piece
_LONG = 1 << 20
#: texts whose ids a task remembers, for copies that follow one another
REMEMBERED = 256


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids as the tokenizers library gives them with add_special_tokens=False.

    Plain text runs through tiktoken with the same file's vocabulary, whose ids are in the order of its merges: four times as fast
    and equal there. Other scripts, special tokens and giant texts run through the tokenizers library itself.
    """

    def __init__(self, path: str | None = None) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        path = path or vocabulary("byte_bpe_50k.json")
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            table = json.load(file)["model"]["vocab"]
        byte = byte_of_char()
        ranks = {bytes(byte[c] for c in token): number for token, number in table.items()}
        self.fast = tiktoken.Encoding(
            "byte_bpe", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=ranks, special_tokens={},
        )

    def ids(self, text: str) -> np.ndarray:
        if len(text) < _LONG and SPECIAL not in text and _PLAIN(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
