"""BPE encoding and decoding with a published vocabulary, in batched merge rounds.

The vocabulary file (a path, given as a parameter) is read once on the driver
and broadcast. In each task the texts are normalised and split into words;
the distinct words of a batch that the task hasn't met are encoded together:
the symbols of all of them lie in one flat array, and each round finds every
word's lowest-rank pair by binary search over the sorted pair keys and merges
its occurrences, left to right, until no word has a pair left.

Kinds of file: BPE with word ends over byte symbols, lower case, special tokens
matched in the raw text (``word_bpe_49k.json``). Decoding joins the ids'
pieces with blanks, as the file has no decoder.

Defined results: a null or empty text has no ids and decodes to the empty text;
rows are independent, so repeats and ties get equal results; a batch is worked
on in slices of bounded size and a text of any length is whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import table
from strata.llm.wordhash import pieces

#: The white space of the file's normaliser, and its word pattern.
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{WHITE}\\p{{L}}\\p{{N}}]+"
#: Words that a task remembers; then it starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1
    prints it, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class Vocabulary:
    """Tables of a vocabulary file: what is broadcast to the tasks."""

    def __init__(self, text: str):
        file = json.loads(text)
        ids, self.special = file["model"]["vocab"], {x["content"]: x["id"] for x in file["added_tokens"]}
        end = file["model"]["end_of_word_suffix"]
        every = {**ids, **self.special}
        self.pieces = [""] * (max(every.values()) + 1)
        for piece, i in every.items():
            self.pieces[i] = piece
        symbols = byte_symbols()
        self.inner = np.array([ids[c] for c in symbols], dtype=np.int64)
        self.last = np.array([ids[c + end] for c in symbols], dtype=np.int64)
        pairs = [(x if isinstance(x, list) else x.split(" ")) for x in file["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())


def encode_words(v: Vocabulary, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words (bytes, none empty) in one flat array, and each one's first place."""
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    data = np.frombuffer(b"".join(found), dtype=np.uint8)
    ends = np.cumsum(lengths)
    symbols = v.inner[data]
    symbols[ends - 1] = v.last[data[ends - 1]]
    word = np.repeat(np.arange(len(found)), lengths)
    out_symbols, out_words = [], []
    none = np.int64(len(v.rank))
    while len(symbols):
        keys = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(v.keys, keys), len(v.keys) - 1)
        rank = np.full(len(symbols), none)
        rank[:-1] = np.where((v.keys[at] == keys) & (word[:-1] == word[1:]), v.rank[at], none)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        counts = np.diff(np.append(first, len(word)))
        best = np.repeat(np.minimum.reduceat(rank, first), counts)
        over = best == none
        if over.any():  # these words are done
            out_symbols.append(symbols[over])
            out_words.append(word[over])
            symbols, word, rank, best = symbols[~over], word[~over], rank[~over], best[~over]
            if not len(symbols):
                break
        chosen = rank == best
        # Of overlapping occurrences (a symbol with itself) every other one, from the left.
        opens = np.flatnonzero(chosen & ~np.concatenate([[False], chosen[:-1]]))
        run = np.cumsum(np.bincount(opens, minlength=len(chosen))) - 1
        chosen &= (np.arange(len(chosen)) - opens[np.maximum(run, 0)]) % 2 == 0
        symbols = symbols.copy()
        symbols[chosen] = v.merged[rank[chosen]]
        stays = ~np.concatenate([[False], chosen[:-1]])
        symbols, word = symbols[stays], word[stays]
    if not out_words:
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    word, symbols = np.concatenate(out_words), np.concatenate(out_symbols)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.searchsorted(word[order], np.arange(len(found) + 1))


class Encoder:
    """Encodes and decodes whole texts; remembers words it has met, up to a bound."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}
        self.white, self.word = regex.compile(f"[{WHITE}]+"), regex.compile(WORD)
        self.special = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None

    def split(self, text: str) -> list[str]:
        """Words of a text; a special token of the raw text is one, marked by a leading newline."""
        if self.special is None or not any(s in text for s in self.v.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self._plain(text[at:m.start()]), "\n" + m[0]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        text = self.white.sub(" ", unicodedata.normalize("NFC", text))
        return self.word.findall(text.replace("Σ", "σ").lower())

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.split(t) if t else [] for t in texts]
        new = {w for ws in split for w in ws} - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, {w for ws in split for w in ws}
        plain = []
        for w in new:
            if w[0] == "\n":
                self.known[w] = np.array([self.v.special[w[1:]]], dtype="<u4").tobytes()
            else:
                plain.append(w)
        ids, first = encode_words(self.v, [w.encode("utf-8") for w in plain])
        ids = ids.astype("<u4")
        for w, a, b in zip(plain, first[:-1].tolist(), first[1:].tolist()):
            self.known[w] = ids[a:b].tobytes()
        look = self.known.__getitem__
        return [np.frombuffer(b"".join(map(look, ws)), dtype="<u4") for ws in split]

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.v.pieces.__getitem__, ids.tolist()))


def encode_documents(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``ids`` (array<int>), ``n_tokens`` and ``decoded``."""
    return _encode(docs, path, keep, text, "ids array<int>, n_tokens long, decoded string",
                   lambda ids, decoded: [pa.array(ids, pa.list_(pa.int32())), _counts(ids), pa.array(decoded, pa.string())])


def digest_documents(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with the number and digests of ids and decoded text."""
    def digests(ids, decoded):
        return [_counts(ids), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in decoded], pa.string())]
    return _encode(docs, path, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _counts(ids) -> pa.Array:
    return pa.array([len(x) for x in ids], pa.int64())


def _encode(docs: DataFrame, path: str, keep: list[str], text: str, columns: str, made) -> DataFrame:
    names = [c.split(" ")[0] for c in columns.split(", ")]
    kept = [c for c in keep if c not in names]
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for part in pieces(batch, "_text", 1 << 20):
                ids = encoder.encode(part.column("_text").to_pylist())
                out = made(ids, [encoder.decode(x) for x in ids])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *out], [*kept, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema)
    return docs.select(*kept, docs[text].alias("_text")).mapInArrow(run, ", ".join(filter(None, [fields, columns])))


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir):
    return digest_documents(table(spark, sf_dir, "documents"), default_path(), ["doc_id"])
