"""Word hashes against words found by a regular expression."""

import random
import re

import pyarrow as pa

from strata.llm import wordhash

_RANDOM = random.Random(7)


def _texts():
    alphabet = ["a", "A", "b", "\x00", "é", "ß", "漢", "😀", "-", "\xa0"]
    made = []
    for _ in range(300):
        made.append("".join(_RANDOM.choice([" ", "\t", "\n", "\r", "\x0b"]) if _RANDOM.random() < 0.2 else _RANDOM.choice(alphabet)
                            for _ in range(_RANDOM.randrange(60))))
    made += ["", None, " ", "x" * 8, "x" * 9, "x" * 16 + " " + "x" * 17, "X" * 16, "\x00", "\x00\x00", "a\x00", "a",
             "y" * 70_000, "y" * 70_001, "z " * 40_000, "é" * 40_000 + " é"]
    return made


def _expected(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_equal_words_have_equal_hashes_and_others_differ(monkeypatch):
    texts = _texts()
    for piece in (16, 1 << 10, 1 << 16):
        monkeypatch.setattr(wordhash, "PIECE", piece)
        found = wordhash.words(pa.array(texts, pa.string()))
        want = [_expected(t) for t in texts]
        assert (found.first[1:] - found.first[:-1]).tolist() == [len(x) for x in want]
        pairs = set(zip([w for x in want for w in x], found.hashes.tolist()))
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def test_lines_are_rows_of_their_own():
    texts = ["one two\nthree", "", "four\n\nfive six", None, "seven"]
    found = wordhash.words(pa.array(texts, pa.string()), lines=True)
    want = [_expected(line) for t in texts for line in (t or "").split("\n")]
    assert (found.first[1:] - found.first[:-1]).tolist() == [len(x) for x in want]
