"""Whole results of operators and of the pipeline against plain Python versions."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import decontaminate, language_model, line_dedup, pieces, quality, token_files
from corpusloom.llm import words as W
from corpusloom.session import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def words(t):
    return [w.decode() for w in (t or "").encode().split()]


def agenda(m, word, seed, limit):
    """The best-scored, leftmost candidate that is not skipped, again and again."""
    at = [(m.chars.get(c, -1), i, i + 1) for i, c in enumerate(word)]
    while True:
        best = None
        for k, (x, y) in enumerate(zip(at, at[1:])):
            union = -1 if min(x[0], y[0]) < 0 else int(m.unions(np.array([x[0]]), np.array([y[0]]))[0])
            span = (x[1] << 42) + (y[1] << 21) + y[2]
            if union >= 0 and not (limit and pieces._mixed((seed + span * int(W.MIX1)) % 2**64) < limit) and (best is None or m.rank[union] < best[0]):
                best = m.rank[union], k, union
        if best is None:
            break
        _, k, union = best
        at[k : k + 2] = [(union, at[k][1], at[k + 1][2])]
    return [i for p, a, _ in at for i in ([p] if p >= 0 else m.byte_id[np.frombuffer(word[a].encode(), np.uint8)].tolist())]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.3])
def test_dropout_is_the_plain_agenda(rate):
    m, rng = pieces.model(pieces.public_model()), random.Random(1)
    limit = np.uint64(int(rate * 2.0**64))
    words_ = [" " + "".join(rng.choice("etaoinshrdlu日é") for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    seeds = np.array([rng.randrange(2**64) for _ in words_], np.uint64)
    flat, n, _, _ = pieces.segment(m, words_, None, seeds, limit)
    for word, seed, own in zip(words_, seeds, np.split(flat, np.cumsum(n)[:-1])):
        want = agenda(m, word, int(seed), int(limit))
        assert own.tolist() == want == pieces.segment_long(m, word, int(seed), int(limit))


def test_a_very_long_word():
    m, rng = pieces.model(pieces.public_model()), random.Random(2)
    text = "x " + "".join(rng.choice("etaoinshrdlu日") for _ in range(1_000_000)) + " y"
    ids = pieces.Encoder(m, 0.1).encode([text, text], [1, 2])
    assert ids[0].tolist() != ids[1].tolist() and all(pieces.decode(m, i).decode() == text for i in ids)


def test_scores_are_the_mixture(docs):
    rows = [(r.doc_id, [w.encode() for w in map(str, words(r.text))]) for r in docs.collect()]
    rows = [(i, [w.lower() for w in ws] + [None]) for i, ws in rows]
    train = [ws for i, ws in rows if zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for ws in train for w in ws)
    two = Counter(p for ws in train for p in zip(["start", *ws], ws))
    n, v = sum(one.values()), len(one)
    totals, weights = language_model.fitted(language_model.counted(docs))
    assert (totals["tokens"], totals["types"]) == (n, v) and np.allclose(weights.sum(1), 1)
    got = {r.doc_id: r.score for r in language_model.score(docs).collect()}
    for i, ws in rows:
        want = 0.0
        for u, w in zip(["start", *ws], ws):
            c = len(train) if u == "start" else one[u]
            a = weights[min(c.bit_length(), language_model.CONTEXT_BUCKETS - 1)]
            want += math.log10(a[0] / (v + 1) + a[1] * one[w] / n + a[2] * two[u, w] / max(c, 1))
        assert abs(got[i] - want) < 1e-9 * abs(want)


def test_weights_are_a_maximum():
    rng = np.random.default_rng(3)
    cells = np.column_stack([np.full(200, 5), rng.integers(-40, 40, 200), rng.integers(-40, 80, 200)])
    n = rng.integers(1, 50, 200).astype(float)
    w = language_model.learn(cells, n)[5]
    p = np.column_stack([np.ones(200), 2.0 ** (cells[:, 1:] / language_model.FINE)])
    gain = lambda x: (n * np.log(p @ x)).sum()
    for _ in range(300):
        other = rng.dirichlet([1, 1, 1])
        assert gain(w) >= gain(0.99 * w + 0.01 * other) - 1e-3


def cut_lines(rows, least):
    """[(id, text)] in order of id -> {id: indexes of the lines that go}."""
    lines = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if x.encode().split()] for i, t in rows}
    count = {i: [len(x.encode().split()) for _, x in own] for i, own in lines.items()}
    seen = defaultdict(set)
    for i in sorted(lines):
        own, n = lines[i], len(lines[i])
        for a in range(n):
            total = 0
            for b in range(a, n):
                total += count[i][b]
                if total >= least:
                    seen[tuple(x for _, x in own[a : b + 1])].add((i, a))
                    break
        for b in range(n):
            total = 0
            for a in range(b, -1, -1):
                total += count[i][a]
                if total >= least:
                    seen[tuple(x for _, x in own[a : b + 1])].add((i, a))
                    break
    gone = defaultdict(set)
    for window, places in seen.items():
        first = min(places)
        for i, a in places - {first}:
            start = max(a, first[1] + len(window)) if i == first[0] else a
            gone[i].update(range(start, a + len(window)))
    out = defaultdict(set)
    for i, own in gone.items():  # blank lines between two that go, go with them
        for s in own:
            out[i].update(range(lines[i][s][0], lines[i][s + 1][0] if s + 1 in own else lines[i][s][0] + 1))
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choice(["", *(f"l{k} " * (1 + k % 4) for k in range(9))]) for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(100, "\n".join(["a b c d e"] * 9)), (101, "q\n" + "\n".join(["a b c d e"] * 5))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=8, counted="n").collect()}
    gone = cut_lines(rows, 8)
    for i, t in rows:
        assert got[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), i
        assert got[i].n == sum(bool(x.strip()) for k, x in enumerate(t.split("\n")) if k in gone[i])
    assert got[100].text == "a b c d e\na b c d e"  # the first copy of what repeats stays whole


def test_many_equal_lines(spark):
    line = "one two three four five six seven"
    text = "\n".join([line] * 100_000)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()}
    assert got == {1: "\n".join([line] * 8), 2: ""}


def test_files_are_closed_at_a_number_of_ids(monkeypatch, spark, docs, tmp_path):
    import public_tokenizers
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    import pyspark

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
    monkeypatch.setattr(W, "STEP", 1)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.limit(20).collect())
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["doc_id", "text"])
    files = [f for b in token_files._write(str(tmp_path), path)(iter([batch])) for f in b.to_pylist()]
    assert len(files) > 3 and sum(f["docs"] for f in files) == 20
    start = 0
    want = []
    for i, t in rows:
        n = len(token_files.WordIds(path).encode([t], 1)[0])
        want.append((i, start, n))
        start += n
    listed, start = [], 0
    for f in files:
        listed.append({"path": f["path"], "start": start})
        start += f["ids"]
    got = [tuple(r.values())[:3] for b in token_files._read(iter([pa.RecordBatch.from_pylist(listed)])) for r in b.to_pylist()]
    assert got == want


def test_a_host_that_fails(spark):
    good = "word " * 5 + " ".join(f"a{i}" for i in range(40))
    noise = "# $ % & " * 3 + good
    rows = [(i, good if i % 20 else "few", f"h{i % 8}", "k") for i in range(800)] + [(1000 + i, noise if i % 3 else good, "bad", "k") for i in range(300)] + [(2000, good, None, "k"), (2001, None, None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string")
    got = {r.doc_id: r for r in quality.host_rules(df).collect()}
    for i, t, h, _ in rows:
        assert got[i].base_failed == (len(words(t)) < 20) and got[i].kept == (len(words(t)) >= 20 and h != "bad")
    kept = quality.keep_documents(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)
    assert {r.n_words for r in kept.collect()} == {"k"}  # a caller's column of a measure's name


def plain_quality(rows):
    found = {}
    for i, t, h in rows:
        w, t = words(t), t or ""
        grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = {k + j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        found[i] = h, (len(w) < 20, 100 * len(again) > 30 * len(w), 10 * sum(t.count(c) for c in "#*$%&|<>") > len(w), 10 * (len(lines) - len(set(lines))) > 3 * len(lines))
    hosts = defaultdict(list)
    for h, fails in found.values():
        hosts[h].append(fails)
    bad = set()
    for r in range(4):
        f, n = {h: sum(x[r] for x in own) for h, own in hosts.items()}, {h: len(own) for h, own in hosts.items()}
        mean = sum(f.values()) / len(found)
        between = max(sum(f[h] ** 2 / n[h] for h in f) / len(found) - mean**2 - mean * (1 - mean) * len(f) / len(found), 1e-9)
        strength = max(1.0, min(1e6, mean * (1 - mean) / between - 1))
        for h in f:
            rate = (f[h] + mean * strength) / (n[h] + strength)
            if rate - 3 * math.sqrt(rate * (1 - rate) / (n[h] + strength + 1)) > max(2 * mean, 0.2):
                bad.add(h)
    return {i for i, (h, fails) in found.items() if not (fails[0] or fails[1]) and h not in bad}


def plain_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n, k = len(sets[a]), len(sets[b])
            if n and k and 80 * max(n, k) <= 100 * min(n, k):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (n + k - both):
                    one, two = sorted((find(a), find(b)))
                    root[two] = one
    return {i: find(i) for i in ids}


def test_pipeline_row_for_row(spark, docs):
    import corpus_pipeline

    rows = {r.doc_id: r for r in docs.collect()}
    stay = plain_quality([(i, r.text, r.source) for i, r in rows.items()])
    texts = {i: rows[i].text for i in stay}
    gone = cut_lines(sorted(texts.items()), line_dedup.MIN_WORDS)
    for i in list(texts):
        if gone[i]:
            texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone[i])
            if not texts[i].encode().split():
                del texts[i]
    of = plain_components(texts.items())
    texts = {i: t for i, t in texts.items() if of[i] == i}
    bench = [x for x in (decontaminate.folded(r.text) for r in table(spark, SF, "benchmark").collect()) if x]
    peq = [(b, decontaminate.masks(b), decontaminate.budget(b, decontaminate.ERROR_RATE)) for b in bench]
    clean = {}
    for i, t in texts.items():
        low = decontaminate.folded(t)
        if not any(b in low or decontaminate.myers(len(b), p, low)[0] <= k for b, p, k in peq):
            clean[i] = t
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(clean)
    m = pieces.model(pieces.public_model())
    limit, mask = int(pieces.RATE * 2.0**64), 2**64 - 1
    for i, t in clean.items():
        doc = pieces._mixed((out[i].variant ^ pieces.SEED * 0x9E3779B97F4A7C15) & mask)
        want = []
        for k, word in enumerate(re.findall(r"\n| *[^ \n]+| +", " " + t)):
            want += pieces.segment_long(m, word, pieces._mixed((doc + (k + 1) * int(W.MIX2)) & mask), limit)
        assert out[i].ids == want and out[i].lossless and (out[i].lang, out[i].source) == (rows[i].lang, rows[i].source)


def test_stages_on_odd_input(spark):
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, "en", None, 0, "x", 1), (2, "", "en", "s", 0, "x", 1), (3, long, None, "s", None, "x", 1), (3, long, None, "s", None, "x", 1), (None, long + " end", "en", "s", 5, None, 1), (4, "a b c d e " * 3 + long[::-1], "en", "s", 9, "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, item_id string, node long"
    for df, least in ((spark.createDataFrame(rows, schema), 3), (spark.createDataFrame([], schema), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            df = spark.createDataFrame(out.collect(), schema)
        last = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
        assert len(last) >= least and all(r.lossless for r in last)

