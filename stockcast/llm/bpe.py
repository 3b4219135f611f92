"""BPE encoding and decoding with tree concatenation.

Short texts are encoded where they lie, each distinct word once per task. A long text is cut into segments of equal length, wherever
that falls; all segments are encoded in parallel, and neighbours are joined in a tree, level by level, each pair of a level in
parallel. At a join, a window around the cut is split into words anew and grows until one word begins at the same place in the
window and in the left part, and one in the window and in the right part: from there on both sides agree, as splitting goes
from left to right and looks at most two characters ahead. The left part's words before, the window's between and the right part's
words after are then the whole text's words. Words longer than `UNSPLIT` characters are encoded by the same tree over tokens:
halves first, then a growing window of tokens around the join, until its outermost tokens are those of both halves.

Special tokens written out in a text are single tokens and hard borders, as in the library.

Defined cases: a null text counts as empty, which has no tokens. Null and repeated ids are rows like others.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.text import materialize, on_batches
from stockcast.llm.tokenizing import byte_of_char, vocabulary

SEGMENT, UNSPLIT, WINDOW, MARGIN, TOKENS = 1 << 15, 4096, 64, 8, 8
#: white space as the library's pattern has it, as far as plain texts can hold it
SPACE = " \t\n\r\x0b\x0c\x85\xa0" + "".join(map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]))
#: Latin letters, marks and signs and general punctuation: here Python and the library agree on lower case and on kinds of characters
_PLAIN = re.compile("[\x00-\u024f\u2000-\u206f]*").fullmatch


def _kinds(first: str) -> str:
    """The characters up to U+024F and of general punctuation whose category begins with `first`, as a class for re."""
    chars = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070)]]
    return "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith(first))


class WordBpe:
    """The vocabulary word_bpe_49k.json: lower case, words by pattern, each word's end marked."""

    LIMIT = 1 << 18

    def __init__(self, path: str | None = None) -> None:
        from tokenizers import Tokenizer

        with open(path or vocabulary("word_bpe_49k.json"), encoding="utf-8") as file:
            spec = json.load(file)
        spec |= {"truncation": None, "padding": None}
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.borders = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        bare = spec | {"normalizer": None, "added_tokens": []}
        self.word = Tokenizer.from_str(json.dumps(bare))
        self.end = Tokenizer.from_str(json.dumps(bare | {"pre_tokenizer": None}))
        self.middle = Tokenizer.from_str(json.dumps(bare | {
            "pre_tokenizer": None, "model": spec["model"] | {"end_of_word_suffix": None}}))
        self.suffix = spec["model"]["end_of_word_suffix"]
        size = max(*spec["model"]["vocab"].values(), *self.special.values()) + 1
        self.token, self.length = [b""] * size, np.zeros(size, np.int64)
        for text, number in [*spec["model"]["vocab"].items(), *self.special.items()]:
            self.token[number] = text.encode()
            self.length[number] = len(text.removesuffix(self.suffix) or text)
        self.char = {b: c for c, b in byte_of_char().items()}
        letters, digits = _kinds("L"), _kinds("N")
        self.plain_words = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{re.escape(SPACE)}{letters}{digits}]+"
        )
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> str:
        """As the library does, but for white space, which no word holds."""
        return text.lower() if _PLAIN(text) else self.whole.normalizer.normalize_str(text)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Begin and end of the words of a normalised text."""
        if _PLAIN(text):
            return [m.span() for m in self.plain_words.finditer(text)]
        return [span for _, span in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        return self.plain_words.findall(text) if _PLAIN(text) else [text[a:b] for a, b in self.spans(text)]

    def encode_word(self, word: str) -> tuple[bytes, bytes]:
        """The ids' bytes and the decoded text of one word."""
        got = self.known.get(word)
        if got is None:
            if len(word) > UNSPLIT:
                ids = self.unsplit("".join(self.char[b] for b in word.encode()), True)
            else:
                ids = self.word.encode(word, add_special_tokens=False).ids
            got = (np.array(ids, "<u4").tobytes(), b" ".join(self.token[k] for k in ids))
            if len(word) <= 64:
                if len(self.known) >= self.LIMIT:
                    self.known.clear()
                self.known[word] = got
        return got

    def unsplit(self, chars: str, last: bool, limit: int = UNSPLIT) -> list[int]:
        """Tokens of a long word (in byte-level characters), whose end is the word's if `last`."""
        if len(chars) <= limit:
            return (self.end if last else self.middle).encode(chars, add_special_tokens=False).ids
        half = len(chars) // 2
        return self.join_tokens(self.unsplit(chars[:half], False, limit), self.unsplit(chars[half:], last, limit), chars, half, last)

    def join_tokens(self, left: list[int], right: list[int], chars: str, cut: int, last: bool) -> list[int]:
        k = TOKENS
        while True:
            a, b = left[-k:], right[:k]
            begin = cut - int(self.length[a].sum())
            end = cut + int(self.length[b].sum())
            whole = len(b) == len(right)
            window = (self.end if last and whole else self.middle).encode(chars[begin:end], add_special_tokens=False).ids
            if (len(a) == len(left) or window[:2] == a[:2]) and (whole or window[-2:] == b[-2:]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
            k *= 2

    def digest(self, ids: list[bytes], decoded: list[bytes]) -> tuple[int, str, str]:
        data = b"".join(ids)
        return len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256(b" ".join(decoded)).hexdigest()

    def encode_text(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and the SHA-256 of ids and of the decoded text."""
        ids, decoded = [], []
        for part in self.borders.split(text) if "<|" in text else [text]:
            if part in self.special:
                pairs = [(np.array([self.special[part]], "<u4").tobytes(), part.encode())]
            else:
                pairs = list(map(self.encode_word, self.words(self.normalise(part))))
            ids += [x[0] for x in pairs]
            decoded += [x[1] for x in pairs]
        return self.digest(ids, decoded)

    # a node of the tree: its text, where its words start, and each word's ids; hard borders lie between trees

    def node(self, text: str) -> dict:
        if text in self.special:
            return {"text": text, "starts": np.zeros(1, np.int64), "ids": [np.array([self.special[text]], "<u4").tobytes()]}
        spans = self.spans(text)
        return {"text": text, "starts": np.array([a for a, _ in spans], np.int64),
                "ids": [self.encode_word(text[a:b])[0] for a, b in spans]}

    def join(self, left: dict, right: dict) -> dict:
        n = len(left["text"])
        text = left["text"] + right["text"]
        size = WINDOW
        while True:
            a, b = max(0, n - size), min(len(right["text"]), size)
            spans = self.spans(text[a : n + b])
            starts = np.array([x for x, _ in spans], np.int64) + a
            first = 0 if a == 0 else next((x for x in np.intersect1d(starts, left["starts"]).tolist() if x <= n - MARGIN), None)
            whole = b == len(right["text"])
            after = len(text) if whole else next((x for x in np.intersect1d(starts, right["starts"] + n).tolist() if x <= n + b - MARGIN), None)
            if first is not None and after is not None:
                break
            size *= 2
        keep_left = int(np.searchsorted(left["starts"], first))
        keep_right = int(np.searchsorted(right["starts"] + n, after))
        own = [(x + a, y + a) for x, y in spans if first <= x + a < after]
        return {
            "text": text,
            "starts": np.concatenate([left["starts"][:keep_left], np.array([x for x, _ in own], np.int64), right["starts"][keep_right:] + n]),
            "ids": left["ids"][:keep_left] + [self.encode_word(text[x:y])[0] for x, y in own] + right["ids"][keep_right:],
        }


FIRST = "kind int, doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, uid long, section int, at int, total int, text string"
NODE = "uid long, doc_id long, section int, at int, total int, text string, starts binary, sizes binary, ids binary"


def _first(docs: DataFrame, path: str | None, segment: int) -> DataFrame:
    """Kind 0: a short text's result. Kind 1: one segment of a long text; its sections lie between special tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe, uid = WordBpe(path), TaskContext.get().partitionId() << 32
        for batch in batches:
            done, ids, cut = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                if len(text) <= 2 * segment:
                    ids.append(doc_id)
                    done.append(bpe.encode_text(text))
                    continue
                uid += 1
                for section, part in enumerate(x for x in bpe.borders.split(text) if x):
                    part = part if part in bpe.special else bpe.normalise(part)
                    total = max(1, -(-len(part) // segment))
                    cut += [(doc_id, uid, section, k, total, part[k * segment : (k + 1) * segment]) for k in range(total)]
            n, m = len(done), len(cut)
            yield {
                "kind": [0] * n + [1] * m, "doc_id": ids + [x[0] for x in cut],
                **{name: [x[k] for x in done] + [None] * m for k, name in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))},
                **{name: [None] * n + [x[k + 1] for x in cut] for k, name in enumerate(("uid", "section", "at", "total", "text"))},
            }

    return on_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, FIRST)


def _as_row(node: dict) -> dict:
    return {"text": node["text"], "starts": node["starts"].astype(np.int64).tobytes(),
            "sizes": np.array([len(x) for x in node["ids"]], np.int32).tobytes(), "ids": b"".join(node["ids"])}


def _as_node(row: dict) -> dict:
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int32).astype(np.int64)).tolist()
    data = row["ids"]
    return {"text": row["text"], "starts": np.frombuffer(row["starts"], np.int64),
            "ids": [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []}


def _encoded(segments: DataFrame, path: str | None) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = WordBpe(path)
        for batch in batches:
            for row in batch.to_pylist():
                made = row | _as_row(bpe.node(row["text"]))
                yield {k: [v] for k, v in made.items()}

    names = ["uid", "doc_id", "section", "at", "total", "text"]
    return on_batches(segments.repartition("uid", "section", "at").select(*names), work, NODE)


def _joined(nodes: DataFrame, path: str | None) -> DataFrame:
    """One level up: pairs of neighbours become one."""
    level = nodes.withColumn("pair", F.floor(F.col("at") / 2).cast("int"))
    loaded: list[WordBpe] = []  # once per task

    def own(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["at"])
        row = rows[0]
        if len(rows) == 2:
            if not loaded:
                loaded.append(WordBpe(path))
            row = row | _as_row(loaded[0].join(*map(_as_node, rows)))
        row |= {"at": rows[0]["at"] // 2, "total": -(-rows[0]["total"] // 2)}
        return pa.Table.from_pylist([{k: row[k] for k in NAMES}], schema=group.select(NAMES).schema)

    return level.groupBy("uid", "section", "pair").applyInArrow(own, NODE)


NAMES = [x.strip().split(" ")[0] for x in NODE.split(",")]


def _finished(nodes: DataFrame, path: str | None) -> DataFrame:
    """Digests of the documents whose sections are whole."""
    loaded: list[WordBpe] = []

    def own(group: pa.Table) -> pa.Table:
        if not loaded:
            loaded.append(WordBpe(path))
        bpe = loaded[0]
        rows = sorted(group.select(["doc_id", "section", "ids"]).to_pylist(), key=lambda r: r["section"])
        data = b"".join(r["ids"] for r in rows)
        n, ids, text = bpe.digest([data], [bpe.token[k] for k in np.frombuffer(data, "<u4").tolist()])
        return pa.table({"doc_id": group.column("doc_id")[:1], "n_tokens": [n], "ids_sha256": [ids], "decoded_sha256": [text]})

    return nodes.select("uid", "doc_id", "section", "ids").groupBy("uid").applyInArrow(
        own, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def round_trip(docs: DataFrame, path: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    first = materialize(_first(docs, path, segment))
    short = first.where("kind = 0").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    segments = first.where("kind = 1")
    total = segments.agg(F.max("total")).first()[0]
    if total is None:
        return short
    nodes = materialize(_encoded(segments, path))
    while total > 1:
        nodes = materialize(_joined(nodes, path))
        total = -(-total // 2)
    return short.unionByName(_finished(nodes, path))
