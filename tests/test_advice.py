"""Jobs that were once done in part: each test fails on the earlier code."""
import random
from corpusloom import queries
from corpusloom.llm import ngram_join, pieces
from corpusloom.operators import sampling


def test_diverse_selection_sees_every_user(spark, tmp_path):
    rows = [(u, t) for u in range(1500) for t in (["view"] if u < 1400 else ["view", "click"])] + [(1499, "rare"), (1200, "odd")]
    spark.createDataFrame(rows, "user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = [r.user_id for r in queries.diverse_selection(spark, str(tmp_path)).orderBy("rank").collect()]
    profiles = {}
    for u, t in rows:
        profiles.setdefault(u, set()).add(t)
    assert got == sampling.diverse(sorted(profiles.items()), 20) and {1499, 1200} <= set(got)


def test_each_occurrence_has_its_own_dropout(spark):
    path = pieces.public_model()
    m = pieces.model(path)
    text = " ".join(["international"] * 200)
    rows = spark.createDataFrame([(i, text) for i in range(40)] + [(3, text)], "doc_id long, text string")
    got = [(r.doc_id, tuple(r.ids)) for r in pieces.encode_documents(rows, path).where("lossless").collect()]
    assert len(got) == 41 and len(set(got)) == len({ids for _, ids in got}) == 40


def test_nodes_give_what_each_occurrence_gives_alone(monkeypatch):
    m = pieces.model(pieces.public_model())
    texts = ["the internationalisation of the cafés, 日本 🎉 " * 30, "", "a" * 300 + " the  the\n", " ".join(f"word{i % 50}" for i in range(3000))]
    kept = pieces.Encoder(m, 0.2).encode(texts, [5, 6, -7, 2**62])
    pieces_by_word = len({tuple(x) for x in (pieces.Encoder(m, 0.2).encode(["international"], [v])[0].tolist() for v in range(200))})
    monkeypatch.setattr(pieces, "MANY", -1)
    alone = pieces.Encoder(m, 0.2).encode(texts, [5, 6, -7, 2**62])
    assert [x.tolist() for x in kept] == [x.tolist() for x in alone] and pieces_by_word > 4
    assert [pieces.decode(m, x).decode() for x in kept] == texts


def test_every_link_is_counted(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)  # components of several blocks
    rng = random.Random(7)
    base = [f"v{i}" for i in range(90)]
    rows = [(1, None), (2, ""), (3, "lone words here")]
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(90)] = f"z{rng.randrange(10**6)}"
        rows += [(100 + i, " ".join(w))] * (2 if i % 9 == 0 else 1) + ([(1000 + i, " ".join(w).upper())] if i % 5 == 0 else [])
    sets = [(i, frozenset(zip(*[w[j:] for j in range(min(5, len(w)))])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])) for i, w in ((i, (t or "").lower().split()) for i, t in rows)]
    want = sorted((i, sum(bool(s & o) and 100 * len(s & o) >= 80 * len(s | o) for _, o in sets) - bool(s)) for i, s in sets)
    got = sorted((r.doc_id, r.n_links) for r in ngram_join.counted_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == want and max(n for _, n in want) < len(rows) - 4


def test_rare_labels_are_in_every_split():
    sizes = {f"g{i:02}": 10 for i in range(40)}
    labels = {g: {"rare": 10 if i < 7 else 0, "common": 5} for i, g in enumerate(sizes)}
    bounds = {"train": (0.7, 0.8), "val": (0.1, 0.15), "test": (0.1, 0.15)}
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}

    def objective(got):
        whole = {"": 400, "rare": 70, "common": 200}
        totals = {s: {"": sum(sizes[g] for g in got if got[g] == s)} | {x: sum(labels[g][x] for g in got if got[g] == s) for x in ("rare", "common")} for s in shares}
        return sampling.split_objective(totals, whole, shares, ["common", "rare"], bounds)

    out = sampling.assign_groups(sizes, shares, labels=labels, bounds=bounds)
    greedy = sampling.assign_groups(sizes, shares, 0, labels=labels, bounds=bounds)
    assert {out[g] for g in list(sizes)[:7]} == set(shares) and set(out) == set(sizes)
    assert objective(out) <= objective(greedy) and [list(out.values()).count(s) for s in shares] == [28, 6, 6]


def test_split_takes_every_user(spark):
    sf = "/root/testdata/sf0.001"
    users = {r.user_id for r in spark.read.parquet(f"{sf}/events.parquet").select("user_id").distinct().collect()}
    got = queries.group_stratified_split(spark, sf).collect()
    assert len(got) == len(users) and {r.user_id for r in got} == users
    assert {r.split for r in got} == {"train", "validation", "test"}
