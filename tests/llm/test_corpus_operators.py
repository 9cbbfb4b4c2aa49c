"""Corpus operators against brute force on a small table with every odd case:
nulls, empty and long texts, ties, repeated rows, clashing column names."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bpe, decontamination, license_scan, line_dedup, ngram_join, pii, quality_rules, sharding, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, copy string, kept_chars long, at string, key long"
SPACES = re.compile(r"[\x20\x09-\x0d]+")


def words(text):
    return [w for w in SPACES.split((text or "").translate({c: c + 32 for c in range(65, 91)})) if w]


def shingles(w):
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(sets):
    """Least index of each one's class; links are Jaccard 0.75 or more."""
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(sets))]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    def sentence(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))
    texts = [None, "", "  \n\t ", "one two three", "one two three", "Mixed CASE words here now", sentence(30000)]
    base = "\n".join(sentence(40) for _ in range(4))
    passage = sentence(60)
    for k in range(40):  # edited copies of one text, more and less
        w = base.split(" ")
        for _ in range(k // 4):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [base] * 3
    texts += [f"{sentence(80)}\n{passage} {sentence(30)}" for _ in range(5)]
    texts += [f"{sentence(70)}\nshared boilerplate line of the host number nine" for _ in range(30)]
    texts += ["Mail und.34@mail7.example.com or 10.0.0.1 card 4111 1111 1111 1111 call +1 (017) 555-7713 a.b@c.d.e_f@g.h 999.1.1.1",
              'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' * 3, "under the MIT license and cc by nc; " + sentence(60)]
    out = [(i, t, "en", None if i % 11 == 0 else f"s{i % 2}", len(t or ""), "n", "c", 5, "a", 1) for i, t in enumerate(texts)]
    return [*out, out[8], (None, base, *out[0][2:]), (None, None, *out[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_counts_and_repeats(docs, rows, empty):
    got = defaultdict(set)
    for r in quality_rules.judge(docs).collect():
        got[r.doc_id].add((r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed))
    for i, text, *_ in rows:
        w = [x for x in SPACES.split(text or "") if x]
        places = defaultdict(list)
        for k in range(len(w) - 2):
            places[tuple(w[k:k + 3])].append(k)
        covered = {k + d for p in places.values() if len(p) > 1 for k in p for d in range(3)}
        lines = [x for x in (text or "").split("\n") if SPACES.sub("", x)]
        want = (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert want in got[i]
    assert quality_rules.judge(empty).count() == 0 and quality_rules.kept_documents(empty).count() == 0
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns and {r.node for r in kept.collect()} == {"n"}


def test_quality_shared_lines_of_unrelated_documents_and_versions(spark):
    rnd = random.Random(11)

    def line():
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(12))
    shared, base = [line() for _ in range(10)], [line() for _ in range(8)]
    rows = [(i, "\n".join([*shared, line(), line()]), "pages") for i in range(120)]
    for i in range(200, 260):  # versions of one text, some words edited
        version = [x.split() for x in base]
        for _ in range(1 + i % 2):
            rnd.choice(version)[rnd.randrange(12)] = f"edit{i}"
        rows.append((i, "\n".join(map(" ".join, version)), "versions"))
    rows += [(300 + i, "\n".join(line() for _ in range(8)), "others") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = quality_rules.judge(docs, quality_rules.QualityRules(spare_versions=True)).collect()
    assert {(r.source, r.depleted and not r.version) for r in got} == {("pages", True), ("versions", False), ("others", False)}
    own = {i: sum(map(len, t.split("\n")[10:])) for i, t, s in rows if s == "pages"}
    assert {r.doc_id: r.kept_chars for r in got if r.source == "pages"} == own
    kept = quality_rules.kept_documents(docs)
    assert {r.doc_id for r in kept.collect()} == {i for i, _, s in rows if s != "pages"}


def test_quality_verdicts_by_documents_per_host(spark):
    rnd = random.Random(5)
    frequent = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(3, 9))) for _ in range(12)]
    rows = []
    for i in range(240):
        lines = [rnd.choice(frequent[:1 + i % 12]) for _ in range(rnd.randint(0, 6))]
        lines += [" ".join(f"x{rnd.randrange(9000)}" for _ in range(8)) for _ in range(rnd.randint(0, 7))]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(x.upper() if rnd.random() < 0.2 else "\t" + x + "  " for x in lines), rnd.choice(["a", "b", None]), "r", "h", True))
    rows += [(900 + i, *rows[7][1:]) for i in range(30)] + [rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string, host string, version boolean").repartition(5)
    norm = lambda t: [x for x in (SPACES.sub(" ", y.lower()).strip() for y in (t or "").split("\n")) if x]
    held = defaultdict(set)
    for _, t, s, *_ in rows:
        for x in norm(t):
            held[s, x].add(t)
    want = []
    for i, t, s, *_ in rows:
        total = sum(map(len, norm(t)))
        left = sum(len(x) for x in norm(t) if len(held[s, x]) <= 20)
        w = [x for x in SPACES.split(t) if x]
        want.append((i, s, "r", "h", total, left, left < 0.5 * total, len(w) < 50))
    got = [(r.doc_id, r.source, r.row, r.host, r.all_chars, r.kept_chars, r.depleted, r.n_words < 50) for r in quality_rules.judge(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len({w[6] for w in want}) == 2
    assert quality_rules.kept_documents(docs).columns == docs.columns


def test_quality_removes_boilerplate_lines(spark):
    rnd = random.Random(13)

    def line(n):
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))
    own = {i: [line(30), "", line(30)] for i in range(40)}
    rows = [(i, "\n".join(["Top  of the Page", *own[i], "top of the page\t", "foot line"]), "s", 7) for i in own]
    rows += [(99, "\n".join([line(60), "foot line"]), "other", 7), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    got = quality_rules.kept_documents(docs)
    assert got.columns == docs.columns
    want = [(i, "\n".join(own[i]), "s", len("\n".join(own[i]))) for i in [*own, 3]] + [rows[40]]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_sharding_moves_rows_into_the_new_shard_alone(docs, rows, empty):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    assert sharding.shard_documents(empty).count() == 0


def test_tree_confines_movement(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    tree = sharding.even_tree(16)
    heavier = {**tree, "region1": {**tree["region1"], "rack0": [(1, 3.0), *tree["region1"]["rack0"][1:]]}}
    both = sharding.place(sharding.place(keys, tree, "k"), heavier, "k", "new_")
    moved = both.filter("region <> new_region").select("new_region").distinct().collect()
    assert {r[0] for r in moved} == {"region1"}
    assert both.filter("region = new_region AND region <> 'region1' AND shard <> new_shard").count() == 0


def test_decontamination_finds_other_numbers_and_checks_slots(spark, docs, empty):
    item = "In total the farmer Alice sold 25 km of rope and then Alice counted 40 more pieces before the long evening market closed"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    same = "Intro words. " + item.replace("Alice", "Beatrix").replace("25", "31") + " and so on"
    mixed = "Intro words. " + item.replace("Alice", "Beatrix", 1).replace("25", "31")
    more = spark.createDataFrame([(901, item.upper()), (902, same), (903, mixed.replace("40", "31")), (904, "nothing of that"), (902, same)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.reparameterised for r in decontamination.leaks(more, bench).collect()}
    assert got[901, 1] is not None and got[902, 1] is True and (903, 1) not in got and (904, 1) not in got
    via_join = {(r.doc_id, r.item_id) for r in decontamination.leaks(more, bench, max_broadcast=0).collect()}
    assert via_join == set(got)
    assert decontamination.leaks(docs, bench).count() == 0 and decontamination.leaks(empty, bench).count() == 0
    assert decontamination.leaks(more, bench.limit(0)).count() == 0
    assert decontamination.clean_documents(docs, bench).count() == docs.count()


def test_decontamination_counts_exact_words_where_slots_differ(spark):
    item = " ".join(["then the man Bob went off"] + [f"word{k}a and other{k}b things" for k in range(6)] + ["until the woman saw Bob again"])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("Bob", "Tom", 1))], "doc_id long, text string")
    found = decontamination.leaks(docs, bench).collect()
    total = len(item.split()) - 7
    assert [(r.found_windows, r.item_windows, r.reparameterised) for r in found] == [(total - 4, total, False)]
    assert decontamination.clean_documents(docs, bench).count() == 0


def test_decontamination_of_short_and_dense_items(spark):
    dense = "mix 3 kg flour 4 kg sugar 5 kg salt 6 kg rice 7 kg beans 8 kg peas so that the whole of it fills 9 bags"
    bench = spark.createDataFrame([(1, "What is the capital of France?"), (2, dense), (3, "one")], "item_id long, text string")
    other = dense.translate(str.maketrans("3456789", "1234567"))
    docs = spark.createDataFrame([(1, "Asked: what is the capital of france? Nobody knew"), (2, "What is the capital of France?"),
                                  (3, f"Now {other} or more"), (4, "what is the price of France in the end"), (5, "has one word of it"),
                                  (6, "He knew what is the capital of France? No"), (7, "one"), (8, "Well\nWhat is the capital of France\nof the world")], "doc_id long, text string")
    for options in ({}, {"max_broadcast": 0}):
        got = {(r.doc_id, r.item_id): (r.first_token, r.last_token, r.reparameterised) for r in decontamination.leaks(docs, bench, **options).collect()}
        assert got[1, 1] == (1, 6, False) and got[2, 1] == (0, 5, False) and got[3, 2][2] is True
        assert set(got) == {(1, 1), (2, 1), (3, 2), (8, 1)}
    assert {r.doc_id for r in decontamination.clean_documents(docs, bench.filter("item_id = 3")).collect()} == set(range(1, 9))


def brute_leaks(docs, bench):
    """Pairs (document, item) by direct comparison of all windows, token by token."""
    def tokens(text):
        out, opens, last = [], True, None
        for m in re.finditer(r"[A-Za-z0-9]+", text):
            gap = text[last[1]:m.start()] if last else ""
            begins = last is None or bool(re.search(r"[\n!.:?]", gap))
            w, kind = m[0], None
            number = w[0].isdigit()
            unit = last is not None and last[2] and w.lower() in decontamination.UNITS
            kind = "N" if number else "U" if unit else "C" if w[0].isupper() and not begins else None
            out.append((kind, w.lower(), begins))
            last = (m.start(), m.end(), number)
        return out
    found = set()
    for i, t in bench:
        a = tokens(t)
        size = min(8, len(a))
        if size < 4:
            continue
        n = len(a) - size + 1
        enough = [sum(k is None for k, *_ in a[p:p + size]) >= 4 for p in range(n)]
        for d, text in docs:
            b, shifts = tokens(text), defaultdict(lambda: (set(), set()))
            for p in range(n):
                for q in range(len(b) - size + 1):
                    x, y = a[p:p + size], b[q:q + size]
                    if size < 8 and not (y[0][2] and (q + size == len(b) or b[q + size][2])):
                        continue
                    if [w for _, w, _ in x] == [w for _, w, _ in y]:
                        shifts[q - p][0].add(p)
                    if enough[p] and [k or w for k, w, _ in x] == [k or w for k, w, _ in y] and any(k for k, *_ in x):
                        shifts[q - p][1].add(p)
                    elif enough[p] and [k or w for k, w, _ in x] == [k or w for k, w, _ in y]:
                        shifts[q - p][1].add(p)
            every, typed = set(), set()
            for shift, (plain, by_type) in shifts.items():
                pairs = {(a[p + e][:2], b[p + e + shift][:2]) for p in by_type for e in range(size) if a[p + e][0]}
                if len(pairs) != len({x for x, _ in pairs}):
                    by_type = set()
                every |= plain | by_type
                typed |= by_type
            cover = len({p + e for p in typed for e in range(size)})
            if n and every and (len(every) >= 0.5 * n or (len(typed) >= max(2, 0.5 * sum(enough)) and cover >= 0.25 * len(a))):
                found.add((d, i))
    return found


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(17)
    plain = [f"{c}{v}{k}" for c in "bdfgk" for v in "aou" for k in "lnrst"]
    names, units = ["Anna", "Boris", "Clara", "Dora"], ["km", "kg", "hours"]
    instruction = "read the text below and choose the best of the four answers given"

    def sentence(n):
        out = []
        for _ in range(n):
            r = rnd.random()
            out += [rnd.choice(plain)] if r < 0.7 else [rnd.choice(names)] if r < 0.8 else [str(rnd.randint(2, 99)), rnd.choice(units)] if r < 0.9 else [str(rnd.randint(2, 9))]
        return " ".join(["so", *out])
    bench = [(i, (instruction + " " if i % 3 == 0 else "") + sentence(rnd.randint(1, 24))) for i in range(60)]
    docs = []
    for d in range(150):
        text = rnd.choice(bench)[1]
        if d % 3:
            values = {v: rnd.choice(names) for v in names} | {str(k): str(rnd.randint(2, 99)) for k in range(2, 100)}
            text = " ".join((values.get(w, w) if d % 3 == 1 or rnd.random() < 0.5 else w) if rnd.random() > 0.04 else rnd.choice(plain) for w in text.split())
        docs.append((d, f"{sentence(20)}{rnd.choice(['. ', chr(10), ' '])}{text}{rnd.choice(['.', ' ', chr(10)])} {sentence(12)}"))
    docs += [(500, instruction), (501, instruction + " " + sentence(30)), (502, "")]
    want = brute_leaks(docs, bench)
    tables = [spark.createDataFrame(x, f"{n} long, text string").repartition(3) for x, n in ((docs, "doc_id"), (bench, "item_id"))]
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(*tables).collect()}
    assert got == want and len(want) > 60 and len({d for d, _ in want}) < len(docs)


def test_pii_base_spans(docs, rows, empty):
    patterns = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        luhn = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")),
                "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]
    got = {r.doc_id: [(pii.KINDS[s.kind], s.start, s.end) for s in r.base] for r in pii.find(docs, ["doc_id"]).collect()}
    for i, text, *_ in rows:
        if i is None:
            continue
        want = sorted((m.start(), k, m.end()) for k, (n, p) in enumerate(patterns) for m in re.finditer(p, text or "") if good(n, m[0]))
        assert got[i] == [(pii.KINDS[k], a, b) for a, k, b in want]
    assert pii.find(empty, ["doc_id"]).count() == 0


def test_license_scan(docs, rows, empty):
    got = {r.doc_id: r for r in license_scan.scan(docs, ["doc_id"]).collect()}
    last = max(i for i, *_ in rows if i is not None)
    assert got[last].base_labels == "cc-by-nc,mit" and (got[last].first_word, got[last].last_word) == (0, 5)
    assert got[0].n_words == 0 and got[0].first_word is None and got[0].labels == "" and got[0].score == 0
    assert license_scan.scan(empty, ["doc_id"]).count() == 0


def test_license_blocks_against_brute_force(spark):
    rnd = random.Random(23)
    filler = ["of", "and", "the", "zeta", "eta", "theta", "in"]
    whole = " ".join(f"term{k}" for k in range(90))
    templates = [*license_scan.TEMPLATES, ("whole", whole)]
    texts = [whole, whole.replace("term4 ", "other "), whole.replace(" ", " x "), whole.replace(" ", " x y ", 88), "\u212aterm1 UNDER the M\u0130T license"]
    for label, t in license_scan.TEMPLATES * 6:
        out = [rnd.choice(filler) for _ in range(rnd.randint(0, 40))]
        for w in t.split(" "):
            out += [w.upper() if rnd.random() < 0.3 else w] if rnd.random() > 0.07 else []
            out += [rnd.choice(filler) for _ in range(rnd.choice([0, 0, 0, 1, 4, 8]))]
        texts.append(" ".join(out))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {}
    for i, t in enumerate(texts):
        w = [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.translate({c: c + 32 for c in range(65, 91)})) if x]
        for n, (label, template) in enumerate(templates):
            tokens, span = set(template.split(" ")), max(64, 2 * len(template.split(" ")))
            best = max(((len(tokens & set(w[s:s + span])), -s) for s in range(len(w)) if w[s] in tokens), default=(0, 0))
            if best[0] >= 0.9 * len(tokens) - 1e-9:
                want[i, n] = (label, -best[1], round(best[0] / len(tokens), 9))
    rows = docs.select(F.col("doc_id").alias("_key"), license_scan.scan_words(F.col("text")).alias("_words"))
    got = {(r._key, r.template): (r.label, r.start, round(r.containment, 9)) for r in license_scan.matches(rows, templates).collect()}
    assert got == want and len(want) > 40 and (0, 11) in want and (1, 11) in want and (3, 11) not in want


def test_near_duplicates(docs, rows, empty):
    root = classes([shingles(words(t)) for _, t, *_ in rows])
    ids = defaultdict(list)
    for k, r in enumerate(root):
        ids[r].append(rows[k][0])
    want = sorted((str(rows[k][0]), len(shingles(words(rows[k][1]))), str(min((i for i in ids[r] if i is not None), default=None))) for k, r in enumerate(root))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_duplicates(docs).collect())
    assert got == want
    assert ngram_join.near_duplicates(empty).count() == 0
    kept = ngram_join.distinct_documents(docs)
    blank = sum(1 for _, t, *_ in rows if not words(t))
    assert kept.columns == docs.columns and kept.count() == blank + len({r for k, r in enumerate(root) if words(rows[k][1])})


def test_line_dedup(docs, rows, empty):
    placed = sorted({((i is None, i or 0), n, line) for i, t, *_ in rows for n, line in enumerate((t or "").split("\n")) if words(line)})
    root = classes([shingles(words(line)) for *_, line in placed])
    want = {(None if placed[k][0][0] else placed[k][0][1], placed[k][1]) for k, r in enumerate(root) if r != k}
    assert {(r.doc_id, r.line) for r in line_dedup.matches(docs).collect()} == want
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    for r in out.filter("doc_id IS NOT NULL AND text IS NOT NULL").collect():
        lines = next(t for i, t, *_ in rows if i == r.doc_id).split("\n")
        assert r.text == "\n".join(x for n, x in enumerate(lines) if (r.doc_id, n) not in want)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_of_short_lines(spark, tmp_path):
    pairs = [(1, "Read more\none line of five words\nhome"), (2, "read  more\nmore read\nHOME\nhome page"), (3, "home")]
    out = corpus_pipeline.lines(spark, spark.createDataFrame(pairs, "doc_id long, text string").repartition(3), str(tmp_path))
    assert sorted(map(tuple, out.collect())) == [(1, pairs[0][1]), (2, "more read\nhome page")]
    named = spark.createDataFrame([(f"d{i}", t, "x", "y", "z") for i, t in pairs], "doc_id string, text string, gone string, lines string, doc string")
    out = line_dedup.dedup_lines(named)
    assert out.columns == named.columns and sorted((r.doc_id, r.text, r.gone) for r in out.collect()) == [("d1", pairs[0][1], "x"), ("d2", "more read\nhome page", "x")]
    assert ngram_join.distinct_documents(named).columns == named.columns


def test_repeated_passages(docs, rows, empty, monkeypatch):
    held = defaultdict(set)
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - 49):
            held[tuple(w[k:k + 50])].add(i if i is not None else t)
    want = set()
    for i, t, *_ in rows:
        w, starts = words(t), []
        starts = [k for k in range(len(w) - 49) if len(held[tuple(w[k:k + 50])]) > 1]
        for k in starts:
            if k - 1 not in starts:
                end = next(e for e in range(k, len(w)) if e + 1 not in starts)
                want.add((i, k, end + 50))
    assert {tuple(r) for r in suffix_dedup.repeated_passages(docs).collect()} == want
    assert suffix_dedup.repeated_passages(empty).count() == 0
    # Large groups take the other way, with the same rows.
    monkeypatch.setattr(suffix_dedup, "GROUP", 4)
    assert {tuple(r) for r in suffix_dedup.repeated_passages(docs).collect()} == want


@pytest.mark.parametrize("within, group", [(False, 8192), (True, 8192), (True, 2)])
def test_without_repeated_passages(spark, monkeypatch, within, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rnd = random.Random(5)
    def sentence(n):
        return [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
    a, b, c = sentence(55), sentence(90), sentence(49)
    texts = [a + sentence(5) + b, sentence(9) + a, b[:70] + sentence(3) + b[20:], c + sentence(1), c + sentence(1), b, sentence(70) * 3,
             sentence(7) + a[:52] + sentence(2) + a, ["again"] * 130, [], sentence(20) + b[5:60] + a[3:] + c, list(a)]
    texts += [sentence(81)] * 3 + [sentence(50)] * 2
    texts = [" ".join(t).upper() if i == 1 else "\n ".join(t) for i, t in enumerate(texts)] + [None]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(None, "x " + " ".join(a)), (5, texts[5])]
    order = sorted({(i is not None, -1 if i is None else i, t) for i, t in pairs if t})
    first = {}
    for named, i, t in order:
        w = words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), (named, i, k if within else 0))
    left = {}
    for named, i, t in order:
        w, cut = words(t), set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] != (named, i, k if within else 0):
                cut |= set(range(k, k + 50))
        left[i] = [x for k, x in enumerate(w) if k not in cut]
    table = spark.createDataFrame([(i, t, "p", "q", "r") for i, t in pairs], "doc_id long, text string, gone string, d string, `left` string").repartition(3)
    out = suffix_dedup.without_repeats(table, within=within)
    got = [(-1 if r.doc_id is None else r.doc_id, words(r.text), r.gone, r.d, r.left) for r in out.collect()]
    want = [(-1 if i is None else i, left.get(-1 if i is None else i, []), "p", "q", "r") for i, t in pairs]
    assert out.columns == table.columns
    assert sorted(got) == sorted(x for x in want if x[1] or not words(texts[x[0]]))
    if not within:  # ids that aren't numbers
        text = F.concat(F.lit("n"), F.col("doc_id").cast("string"))
        found = {tuple(r) for r in suffix_dedup.repeated_passages(table.withColumn("doc_id", text)).collect()}
        assert found == {(f"n{i}" if i is not None else None, *r) for i, *r in map(tuple, suffix_dedup.repeated_passages(table).collect())}


def test_bpe_against_the_library(docs, rows, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.default_path())
    odd = ["a<|endoftext|> B<|startoftext|>", "ΑΣ İx'LL \x85y​z 12½", "aaaaaaaaa " * 5, "🙂👍🏽 \x00�"]
    got = {r.doc_id: (list(r.ids), r.decoded) for r in bpe.encode_documents(docs, bpe.default_path(), ["doc_id"]).collect() if r.doc_id is not None}
    for i, text, *_ in rows:
        if i is not None:
            ids = t.encode(text or "", add_special_tokens=False).ids
            assert got[i] == (ids, t.decode(ids, skip_special_tokens=False))
    encoder = bpe.Encoder(bpe.Vocabulary.read(bpe.default_path()))
    assert [x.tolist() for x in encoder.encode(odd)] == [t.encode(x, add_special_tokens=False).ids for x in odd]
    assert bpe.digest_documents(empty, bpe.default_path(), ["doc_id"]).count() == 0


@pytest.mark.parametrize("per_range", [20_000, 2])
def test_warc_round_trip(spark, monkeypatch, per_range):
    monkeypatch.setattr(warc, "RANGE", per_range)
    rows = [(5, "http://www.Example.com/a?b=2&a=1#x", "é" * 80), (3, "https://example.com:80/a/", "é" * 80), (4, None, None), (9, "", "short"),
            (8, "x", "short"), (None, "http://b.org", "é" * 80), (7, "http://a.b.org/", "z" * 300000), (7, "http://a.b.org/", "z" * 300000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    got = warc.archive(pages).collect()
    assert len(got) == len(rows) and all(r.whole for r in got)
    for r in got:
        html = next(h for p, _, h in rows if p == r.page_id) or ""
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), hashlib.sha256(html.encode()).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 3) if r.page_id in (5, None) else ("response", None))
    order = [(r.url_key, r.time) for r in sorted(got, key=lambda r: r.position)]
    assert order == sorted(order) and sorted(r.position for r in got) == list(range(len(got)))
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_store(spark):
    assert warc.store_uri(spark, "/a/b") == warc.store_uri(spark, "file:/a/b") == warc.store_uri(spark, "file:///a/b") == "file:///a/b"


def test_loser_tree():
    rnd = random.Random(3)
    for k in (1, 2, 3, 7):
        runs = [sorted(rnd.randrange(50) for _ in range(rnd.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "nothing")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(r.n_tokens > 0 for r in out)
    assert len({r.doc_id for r in out}) == len(out)
