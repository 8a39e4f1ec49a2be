"""Exact BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has one BPE encoding, so it has one last token. An automaton over the
vocabulary reports all tokens that end at each position; of these, the last token of the prefix is
the one that is compatible with the last token of the prefix before it (two tokens are
compatible if BPE leaves them as they are side by side). Back-pointers from the word's end give
the ids. Words are cached, so a frequent word is worked out once a task.

The vocabulary file (JSON of the tokenizers format: BPE with a word-end mark, lower case, white
space dropped) is read on the driver and sent to the tasks; its size does not depend on the data.
Null texts count as empty and have no tokens; special tokens written out in a text are tokens.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words kept in a task's cache before the older half goes.
CACHE_WORDS = 200_000
#: Code points that stand for a word's last byte (byte-level character plus this).
_END = 0x10000
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
_ODD = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and the prefix encoder of one vocabulary file."""

    def __init__(self, source: str):
        import ahocorasick

        spec = json.loads(source)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        pieces = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in x)
        self.pieces = regex.compile(pieces)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.bytes = byte_characters()
        self.form = {i: self.symbols(t) for t, i in model["vocab"].items()}
        self.id = {s: i for i, s in self.form.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(self.symbols(a), self.symbols(b)): r for r, (a, b) in enumerate(merges)}
        self.auto = ahocorasick.Automaton()
        for i, s in self.form.items():
            if self.merged(list(s)) == [s]:  # the others never come out of BPE
                self.auto.add_word(s, (i, len(s)))
        self.auto.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def symbols(self, token: str) -> str:
        """A token's characters, the one that carries the word-end mark moved by _END."""
        if token.endswith(self.mark) and len(token) > len(self.mark):
            token = token[:-len(self.mark)]
            return token[:-1] + chr(ord(token[-1]) + _END)
        return token

    def merged(self, parts: list[str]) -> list[str]:
        """Plain BPE of a few symbols, for testing tokens and pairs of tokens."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.rank.get((parts[k], parts[k + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 8 * CACHE_WORDS:
                self.pairs.clear()
            x, y = self.form[a], self.form[b]
            known = self.pairs[a, b] = self.merged(list(x + y)) == [x, y]
        return known

    def piece(self, text: str) -> list[int]:
        """Ids of one word piece: the last token of every prefix, then back along them."""
        chars = "".join([self.bytes[b] for b in text.encode()])
        word = chars[:-1] + chr(ord(chars[-1]) + _END)
        last: list[tuple[int, int] | None] = [None] * (len(word) + 1)
        for end, (token, size) in self.auto.iter(word):
            start = end + 1 - size
            if last[end + 1] is None and (start == 0 or (last[start] is not None and self.compatible(last[start][0], token))):
                last[end + 1] = (token, size)
        ids, at = [], len(word)
        while at:
            token, size = last[at]
            ids.append(token)
            at -= size
        return ids[::-1]

    def chunk(self, text: str) -> bytes:
        """Ids of a text without white space, as little-endian unsigned 32-bit integers."""
        got = self.young.get(text)
        if got is None:
            got = self.old.get(text)
            if got is None:
                got = array("I", [i for p in self.pieces.findall(text) for i in self.piece(p)]).tobytes()
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[text] = got
        return got

    def encode(self, text: str) -> bytes:
        out = []
        for part in self.cut.split(text) if self.cut and "<" in text else (text,):
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            part = unicodedata.normalize("NFC", part)
            if "Σ" in part:  # lower-cased letter by letter, without the final form
                part = part.replace("Σ", "σ")
            part = part.lower()
            chunks = _SPACES.split(part) if _ODD.search(part) else part.split()
            out += map(self.chunk, chunks)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Token texts joined by spaces (the file names no decoder)."""
        return " ".join(map(self.names.__getitem__, array("I", ids)))


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(source: str) -> Vocabulary:
    """The vocabulary of a file's content, built once a process."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(source)
    return _LOADED[key]


def encoded(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if ``keep_ids``, ids (array) and decoded."""
    with open(path, encoding="utf-8") as f:
        source = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(source.value)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                ids = [v.encode(t.as_py() or "") for t in part.column(1)]
                back = [v.decode(i) for i in ids]
                cols = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back])]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols += [pa.array([array("I", i).tolist() for i in ids], pa.list_(pa.int32())), pa.array(back)]
                    names += ["ids", "decoded"]
                yield pa.record_batch(cols, names=names)

    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                          + (", ids array<int>, decoded string" if keep_ids else ""))
    return out.withColumnRenamed("id", id_col)
