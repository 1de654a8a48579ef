import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crateflow.functions.similarity import jaro_winkler, token_set, token_sort
from crateflow.operators import classify, dedup, fuzzy_match, search, tables
from crateflow.session import spread


def test_unknown_country_ranks_first_and_trackless_stay(spark):
    r = spark.createDataFrame([(1, 9, "CD", "US"), (2, 9, "CD", None), (3, 9, "CD", "UK"), (4, 9, None, "UK"), (5, None, "CD", "US"), (6, 9, "CD", "US")], "id int, master_id int, format string, country string")
    counts = spark.createDataFrame([(i, 3) for i in (1, 2, 3, 4, 5)], "release_id int, track_count long")
    ranked = dedup.ranked(r, counts)
    assert {x.id: x["rank"] for x in ranked.collect()} == {2: 1, 1: 2, 3: 3, 4: 1}
    keep = spark.createDataFrame([(1,)], "id int")
    assert sorted(x.id for x in dedup.surplus(ranked, keep).collect()) == [3]


def test_guards(spark):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    with pytest.raises(tables.EmptySourceError):
        tables.upsert(df, df.limit(0), "id", ["t"])
    with pytest.raises(tables.FloorError):
        tables.floor_guard(df, 5, 10)
    assert tables.floor_guard(df, 5, 0).count() == 1
    assert tables.shortfall(df, spark.createDataFrame([(1,), (2,)], "id int")).first().id == 2


@pytest.mark.parametrize("scores,want", [((0.8, 0.1, 0.8), "keep"), ((0.8, 0.8, 0.1), "review"), ((0.9, 0.2, 0.7), "keep"), ((0.66, 0.1, 0.1), "review"), ((0.6, 0.6, 0.6), "prune")])
def test_decision_table(spark, scores, want):
    assert spark.range(1).select(classify.decide(*[F.lit(x) for x in scores]).alias("c")).first().c == want


LIBRARY = [
    ("Ida Mur", "Pale Ferry", "CD", None), ("Ida Mur", "Amber Stone", None, None), ("Bo Lind & Ida Mur", "Two Rivers", "CD", None), ("Nils Ek", "Long Winter", "CD", "Ferry"), ("Various", "Harbor Sampler", "CD", None),
    ("Kip Lor + Ann Lee", "Echo", "LP", None), ("Soundtrack", "Night Train", "CD", "Jo Ray"), (None, "Nothing", "CD", None), ("Empty", "", "CD", None), ("Sampler Makers", "Cut", "CD", None),
]


def _index(spark):
    lib = spark.createDataFrame(LIBRARY, "artist string, title string, format string, other string")
    return classify.library_index(lib, "artist", "title", "other", F.col("format"))


def test_library_index(spark):
    index = _index(spark)
    artists = {r.artist for r in index["artists"].collect()}
    assert artists == {"ida mur", "bo lind and ida mur", "nils ek", "ferry", "kip lor + ann lee", "sampler makers"}
    pairs = {(r.artist, r.title) for r in index["pairs"].collect()}
    # Parts of joint credits are pairs but no artists; an ampersand parts names only where one of them is known. Compilations' aliases don't count.
    assert {("ida mur", "two rivers"), ("bo lind", "two rivers"), ("ann lee", "echo"), ("ferry", "long winter")} <= pairs and not {a for a, _ in pairs} & {"jo ray", "various", "soundtrack"}
    assert {r.title for r in index["compilation_titles"].collect()} == {"harbor sampler", "night train"}
    assert "ferry ||| long winter" not in {r.text for r in index["combined"].collect()}


@pytest.mark.parametrize("artist,title,fmt,want,phase", [
    ("Ida Mur", "Pale Ferry", "CD", "keep", "known"), ("Ida Mur", "Pale Ferry", "Vinyl", "prune", "known"), ("Ida Mur", "Amber Stone", "Vinyl", "keep", "known"),
    ("Ida Mur", "Ferry Pale Again", "Vinyl", "keep", "known"), ("Ida Mur", "Zzz", "CD", "prune", "known"), ("Ferry", "Long Winter", "CD", "keep", "known"),
    ("Bo Lind", "Two Rivers", "CD", "keep", "fuzzy"), ("Yo Lu", "Pale Ferry", "CD", "prune", "screened"), ("Mapped", "Pale Ferry", "CD", "prune", "mapped"), ("Told", "Pale Ferry", "CD", "prune", "known"),
    ("Various", "Harbor Sampler", "CD", "prune", "screened"), ("Ida Mur and the Very Large Orchestra", "Amber Stone", "CD", "keep", "fuzzy"), ("Idda Murr Trio Ferry", "Long Winter", None, "keep", "fuzzy"), ("Idda Murr Ferry", "Pale Ferry", None, "prune", "fuzzy"),
])
def test_classification_table(spark, artist, title, fmt, want, phase):
    told = spark.createDataFrame([("mapped", "prune"), ("told", "keep")], "artist string, decision string")
    row = spark.createDataFrame([(1, artist, title, fmt)], "id int, artist_name string, title_text string, format string")
    got = classify.classify(row, _index(spark), told).first()
    assert (got["class"], got.phase) == (want, phase)


def test_best_class_of_several_credits(spark):
    rows = spark.createDataFrame([(1, "a", "prune", "fuzzy", 0.1), (1, "b", "keep", "known", 1.0), (2, "a", "prune", "known", 0.0), (2, "b", "review", "fuzzy", 0.7)], "id int, artist string, class string, phase string, score double")
    assert {r.id: r["class"] for r in classify.best_class(rows).collect()} == {1: "keep", 2: "review"}
    report = classify.review_by_artist(rows, _index(spark)).collect()
    assert [(r.artist, r.releases, r.best_score) for r in report] == [("b", 1, 0.7)]


def _words(rnd):
    return " ".join(rnd.choice(["ida", "mur", "trio", "the", "bo", "lind", "band", "and", "u2", "x", "orchestra", "idda", "murr", "ab ab"]) for _ in range(rnd.randrange(0, 5)))


@pytest.mark.parametrize("scorer,ratio", [("set", token_set), ("sort", token_sort)])
def test_best_match_equals_brute_force(scorer, ratio):
    rnd = random.Random(7)
    texts = sorted({_words(rnd) for _ in range(150)})
    index = fuzzy_match.Candidates(texts, scorer)
    for _ in range(300):
        q = _words(rnd) if rnd.random() < 0.7 else "".join(rnd.choice("abdimru ") for _ in range(8))
        for cutoff in (60, 70):
            scores = [ratio(q, t) for t in texts]
            top = max(scores)
            assert index.best(q, cutoff) == ((scores.index(top), pytest.approx(top)) if top >= cutoff else None)


def _random_texts(rnd, n, least=1, most=5):
    """Made-up texts of made-up words, with rare letters, repeats and long texts."""
    words = ["".join(rnd.choice("abcdeilmnorstuéжß") for _ in range(rnd.randrange(1, 9))) for _ in range(60)] + [chr(0x4E00 + k) for k in range(60)]
    return sorted({" ".join(rnd.choice(words) for _ in range(rnd.randrange(least, most if rnd.random() < 0.9 else 25))) + rnd.choice(["", " |||"]) for _ in range(n)})


@pytest.mark.parametrize("scorer,ratio", [("set", token_set), ("sort", token_sort)])
@pytest.mark.parametrize("common", [False, True])
def test_searches_for_many_at_once(scorer, ratio, common):
    # Pairs of texts of up to 64 letters are scored in one step, none by itself.
    rnd = random.Random(11)
    texts = _random_texts(rnd, 1200)
    texts = sorted({t.removesuffix(" |||") + " |||" for t in texts}) if common else ["", *texts]
    index, asked = fuzzy_match.Candidates(texts, scorer), [*_random_texts(rnd, 60), "", " |||", *texts[::200]]
    single, of = [], index._ratio
    index._ratio = lambda own, i: single.append(i) or of(own, i)
    got = index.best_all(asked, 0)
    assert all(len(texts[i]) > 64 for i in single if max(map(len, asked)) <= 64 or scorer == "sort") and len(single) < len(asked) * len(texts) / 20
    for q, found in zip(asked, got):
        scores = [ratio(q, t) for t in texts]
        top = max(scores)
        assert found == (None if scorer == "set" and not q else (scores.index(top), top))


def test_jaro_winkler_scores_few_pairs(monkeypatch):
    rnd = random.Random(12)
    names = sorted({f"{''.join(rnd.choice('aeioukrstlmn') for _ in range(rnd.randrange(4, 9)))} {rnd.choice(['records', 'tapes', 'sound'])}" for _ in range(400)} | {"", "x" * 70, "ж records"})
    asked, index, calls = [*names[::8], "recordz", "a" * 66], fuzzy_match.JaroWinkler(names), []
    monkeypatch.setattr(fuzzy_match, "jaro_winkler", lambda a, b: calls.append(a) or jaro_winkler(a, b))
    for cutoff in (0.85, 0.6):
        calls.clear()
        got = index.best_all(asked, cutoff)
        few = len(calls)
        for q, found in zip(asked, got):
            assert found == [(i, -s) for s, i in sorted((-jaro_winkler(q, t), i) for i, t in enumerate(names) if jaro_winkler(q, t) >= cutoff)[:2]]
        assert few < len(asked) * 12


def test_best_clear_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(9)
    texts = sorted({_words(rnd) for _ in range(60)})
    queries = sorted({_words(rnd) for _ in range(40)} | {"", "idamur"})
    monkeypatch.setattr(fuzzy_match, "BLOCK", 17)
    a, b = (spark.createDataFrame([(t,) for t in ts] + [(None,)], "t string") for ts in (queries, texts))
    want = {}
    for q in queries:
        near = sorted((-jaro_winkler(q, t), t) for t in texts if jaro_winkler(q, t) >= 0.85)
        if near and (len(near) == 1 or near[1][0] - near[0][0] >= 0.02):
            want[q] = near[0][1]
    assert {r.text: r.match for r in fuzzy_match.best_clear(a, b).collect()} == want and want
    best = {r.text: (r.match, r.score) for r in fuzzy_match.best_match(a, b, 60).collect()}
    for q in queries:
        top = max(token_set(q, t) for t in texts)
        assert best.get(q) == ((min(t for t in texts if token_set(q, t) == top), pytest.approx(top)) if top >= 60 else None)


def test_compilation_equals_brute_force(spark):
    shelf = ["warp sampler vol 2", "now thats music", "blues roots"]
    titles = ["warp sampler", "music now thats", "rock roots", "warp sampler vol 2", "", "bluez roots"]
    lib = spark.createDataFrame([("Various", t) for t in shelf], "artist string, title string")
    index = classify.library_index(lib, "artist", "title")
    got = {r.id: r["class"] for r in classify.compilation(spark.createDataFrame(list(enumerate(titles)), "id int, title string"), index).collect()}
    assert got == {i: "keep" if t in shelf or max(token_set(t, x) for x in shelf) >= 80 else "prune" for i, t in enumerate(titles)}


def test_two_stage_equals_brute_force(spark):
    index = _index(spark)
    artists, pairs = sorted(r.artist for r in index["artists"].collect()), [(r.artist, r.title) for r in index["pairs"].collect()]
    combined = [r.text for r in index["combined"].collect()]
    asked = [("ida mur trio", "pale ferry"), ("nils eck", "long winter"), ("u2", "zzz"), ("kip lor", "echo echo"), ("ferry", "long winter"), ("bo lind", "amber")]
    got = {(r.artist, r.title): r for r in classify.pair_scores(spark.createDataFrame(asked, "artist string, title string"), index).collect()}
    for artist, title in asked:
        score = max(token_set(artist, a) for a in artists)
        best = next(a for a in artists if token_set(artist, a) == score)
        two = (score * max(token_set(title, t) for a, t in pairs if a == best)) ** 0.5 / 100 if score >= 70 else 0.0
        text = f"{artist} ||| {title}"
        r = got[(artist, title)]
        assert r.two_stage == pytest.approx(two) and r.token_set == pytest.approx(max(token_set(text, c) for c in combined) / 100) and r.token_sort == pytest.approx(max(token_sort(text, c) for c in combined) / 100)
    rows = spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(asked)], "id int, artist string, title string")
    for r in classify.fuzzy_artist(rows, index).collect():
        artist, title = asked[r.id]
        score = max(token_set(artist, a) for a in artists)
        best = next(a for a in artists if token_set(artist, a) == score)
        both = (score * max(token_set(title, t) for a, t in pairs if a == best)) ** 0.5 / 100 if score >= 60 else 0.0
        assert r["class"] == ("keep" if (best, title) in pairs and score >= 60 else "keep" if both >= 0.75 else "review" if both >= 0.65 else "prune")


@pytest.mark.parametrize("artist,combined,variant,want", [
    (0.59, 0.9, False, "no_artist_match"), (0.6, 0.65, True, "near_keep_threshold"), (0.6, 0.749, False, "near_keep_threshold"), (0.9, 0.75, False, "scores_above_keep_on_rescore"),
    (0.9, 0.75, True, "substring_variant"), (0.9, 0.5, True, "substring_variant"), (0.9, 0.6, False, "weak_match"), (None, None, False, "empty_library"),
])
def test_audit_outcomes(spark, artist, combined, variant, want):
    c = lambda x: F.lit(x).cast("double")
    assert spark.range(1).select(classify.fuzzy_outcome(c(artist), c(combined), F.lit(variant)).alias("o")).first().o == want


def test_audit(spark):
    rows = [(1, "Ida Mur", "Pale Ferry"), (2, "Ida Mur", "Zzz"), (3, "Ida Mur", "Pale Ferry Again"), (4, "Qqq", "Zzz"), (5, "Nils Ekström", "Zzz"), (6, None, None)]
    got = {r.id: (r.phase, r.mechanism) for r in classify.audit(spark.createDataFrame(rows, "id int, artist_name string, title_text string"), _index(spark)).collect()}
    assert got[1] == ("exact", "format_mismatch") and got[2] == ("exact", "title_miss") and got[3] == ("exact", "exact_artist_title_above_keep_on_rescore") and got[4] == ("fuzzy", "no_artist_match") and len(got) == 6
    assert got[5] == ("fuzzy", "substring_variant")
    empty = classify.miss_rate(spark.createDataFrame([], "call string")).first()
    assert (empty.sample_size, empty.rate, empty.low, empty.high) == (0, 0.0, 0.0, 0.0)


def test_similarity_join_loses_nothing(spark):
    left, right = ["harbor records", "river audio", "x", "north tapes"], ["harbour records", "records of harbor", "river audios", "xy", "tapes north"]
    a, b = (spark.createDataFrame([(t,) for t in ts], f"{c} string") for ts, c in ((left, "l"), (right, "r")))

    def grams(t):
        return {f"  {w} "[i : i + 3] for w in t.split() for i in range(len(w) + 1)}

    def sim(x, y):
        return len(grams(x) & grams(y)) / len(grams(x) | grams(y))

    want = {(x, y) for x, y in itertools.product(left, right) if sim(x, y) > 0.3}
    assert {(r.l, r.r) for r in search.similarity_join(a, b, "l", "r", 0.3).collect()} == want


def test_similarity_joins_equal_brute_force(spark, monkeypatch):
    # One name has most titles, as compilations have; right texts go in blocks; trigrams that many texts have are left out of the count.
    rnd = random.Random(4)
    titles = [" ".join(rnd.choice(["the", "pale", "ferry", "amber", "stones", "stone", "of", "u2", "ж", ""]) for _ in range(rnd.randrange(0, 5))) for _ in range(160)]
    left, right = ([(rnd.choice(["various"] * 5 + ["1:a", "a", ""]), t) for t in titles[i::2]] + [(None, "pale"), ("a", None)] for i in (0, 1))
    monkeypatch.setattr(search, "BLOCK", 25)
    x, y = spark.createDataFrame(left, "n string, l string"), spark.createDataFrame(right, "n string, r string")

    def grams(t):
        return {f"  {w} "[i : i + 3] for w in t.split() for i in range(len(w) + 1)}

    def sim(a, b):
        return len(grams(a) & grams(b)) / max(len(grams(a) | grams(b)), 1)

    for least, inclusive in ((0.3, False), (0.5, True), (0.75, False)):
        want = {(a, b, round(sim(a, b), 9)) for (_, a), (_, b) in itertools.product(left, right) if a is not None and b is not None and (sim(a, b) > least or inclusive and sim(a, b) == least)}
        got = [(r.l, r.r, round(r.similarity, 9)) for r in search.similarity_join(x, y, "l", "r", least, inclusive).collect()]
        assert set(got) == want and len(got) == len(want) > 9
    got = [(r.n, r.l, r.r) for r in search.similarity_join_within(x, y, "n", "l", "r", 0.3).collect()]
    want = {(n, a, b) for (n, a), (m, b) in itertools.product(left, right) if n is not None and n == m and a is not None and b is not None and sim(a, b) > 0.3}
    assert set(got) == want and len(got) == len(want)


def test_hot_value_goes_in_parts(spark, monkeypatch):
    # Texts of a value that has more than a part are dealt to several, nothing is lost or doubled, and no list of texts goes through the driver.
    monkeypatch.setattr(search, "PART", 3)
    monkeypatch.setattr(search, "cut_lineage", None)
    x = spark.createDataFrame([("various", f"pale ferry {i % 7}") for i in range(9)] + [("b", "pale ferry"), ("b", "--")], "n string, l string")
    y = spark.createDataFrame([("various", f"pale ferry {i % 20}") for i in range(30)] + [("b", "pale ferries"), ("c", "pale ferry")], "n string, r string")
    got = [(r.n, r.l, r.r) for r in search.similarity_join_within(x, y, "n", "l", "r", 0.3).collect()]
    assert sorted(got) == sorted([("various", f"pale ferry {i}", f"pale ferry {k}") for i in range(7) for k in range(20)] + [("b", "pale ferry", "pale ferries")])


def test_collision_candidates_equal_brute_force(spark):
    rnd = random.Random(5)
    words = ["pale", "ferry", "amber", "stones", "stone"]
    titles = list({(rnd.choice(["Ann", "ann", "Bo", "Cy"]), " ".join(rnd.choices(words, k=2)), rnd.choice([None, 1])): 0 for _ in range(25)})
    titles = list({t[:2]: t for t in titles}.values())
    releases = [(i, " ".join(rnd.choices(words, k=rnd.randrange(1, 3)))) for i in range(90)]
    credits = [(rnd.randrange(90), rnd.choice([None, 1, 2, 3]), rnd.choice(["Ann", "ANN", "Dee", "Bo"])) for _ in range(160)]
    credits = list({c[:2]: c for c in credits}.values())  # the order leaves no ties

    def sim(a, b):
        a, b = ({f"  {w} "[i : i + 3] for w in t.lower().split() for i in range(len(w) + 1)} for t in (a, b))
        return len(a & b) / len(a | b)

    want = set()
    for name, title, wrong in titles:
        rows = [(-sim(title, t), i, a or 0, n) for i, t in releases for r, a, n in credits if r == i]
        own = [(*r, 1.0) for r in rows if r[3].lower() == name.lower() and r[0] < -0.3]
        top = sorted(own or [(*r, sim(name, r[3])) for r in rows if r[0] <= -0.5])[:4]
        want |= {(name, title, i, a or None, round(-0.6 * s + 0.4 * x, 6)) for s, i, a, _, x in top if wrong is None or a != wrong}
    t, r, c = (spark.createDataFrame(*x) for x in ((titles, "name string, title string, wrong_id int"), (releases, "id int, title string"), (credits, "release_id int, artist_id int, artist_name string")))
    found = classify.collision_candidates(t, r, c, 4)
    got = [(x.name, x.title, x.release_id, x.artist_id, round(x.score, 6)) for x in found.collect()]
    assert set(got) == want and len(got) == len(want) > 40
    # Names are compared for the first rows of a title only, not for every row that is alike.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" in plan and "array_intersect" not in plan[plan.index("Window ") :]


@pytest.mark.parametrize("scorer", ["set", "sort"])
def test_stretches_of_texts_are_scored_as_they_lie(monkeypatch, scorer):
    # Where most texts of a stretch are asked for, no letter is looked up text by text; either way the ratios are those of brute force.
    monkeypatch.setattr(fuzzy_match, "_CACHED", 64)
    rnd, score = random.Random(6), token_set if scorer == "set" else token_sort
    texts = sorted({" ".join("".join(rnd.sample("abcdefgh", rnd.randrange(2, 6))) for _ in range(rnd.randrange(1, 5))) for _ in range(500)})
    index, looked_up = fuzzy_match.Candidates(texts, scorer), []
    monkeypatch.setattr(index, "_where", lambda c, i, old=index._where: looked_up.append(len(i)) or old(c, i))
    for text in ("abcd hgfe bad", texts[7], "zz a", texts[200] + " cab"):
        own = text.split() if scorer == "sort" else sorted(set(text.split()))
        for step in (1, 2, 5):
            at = np.array([i for i in range(len(texts)) if step != 2 or i % 3], dtype=np.int64)[:: 5 if step == 5 else 1]
            got = index._many(own, " ".join(sorted(own)), at, 0.0)
            # A set ratio's other parts are those of shared words alone, which decide on equal texts.
            part = index._words(own, len(" ".join(own)), [w for w in own if w in index.places]) if scorer == "set" and set(own) & set(index.places) else ((), ())
            alone = dict(zip(*(x.tolist() if len(x) else [] for x in part)))
            assert [max(min(g, 100.0), alone.get(i, 0.0)) for g, i in zip(got.tolist(), at.tolist())] == pytest.approx([score(text, texts[i]) for i in at])
            assert bool(looked_up) == (step == 5)
        looked_up.clear()


def test_resolver(spark):
    rows = [("n1", 7, 1, 0.95), ("n1", 8, 2, 0.90), ("n2", 7, 1, 0.5), ("n2", 8, 2, 0.45), ("n3", 7, 1, 0.3), ("n4", 7, 1, 0.3), ("n4", 7, 2, 0.2), ("n4", 8, 3, 0.5), ("n5", 7, 1, 0.55)]
    names = spark.createDataFrame([(f"n{i}",) for i in range(1, 7)], "name string")
    got = {r.name: (r.status, r.artist_id, r.hits) for r in classify.resolve_collisions(names, spark.createDataFrame(rows, "name string, artist_id int, release_id int, score double")).collect()}
    assert got == {"n1": ("RESOLVED", 7, 1), "n2": ("AMBIGUOUS", 7, 1), "n3": ("UNRESOLVED", 7, 1), "n4": ("RESOLVED", 7, 2), "n5": ("RESOLVED", 7, 1), "n6": ("UNRESOLVED", None, 0)}


def test_spread_rows_stay_spread(spark):
    # Adaptive execution put them into one task where they had been shuffled by the same columns before.
    rows = spread(spark.range(1000).selectExpr("cast(id as string) AS text").distinct(), "text")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_filter_reaches_the_scan(spark):
    from conftest import SF

    plan = spark.read.parquet(f"{SF}/releases.parquet").where("master_id is not null").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(master_id)" in plan and "title" not in plan.split("ReadSchema")[1]
