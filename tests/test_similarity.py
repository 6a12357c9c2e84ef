"""Similar pairs against a comparison of all pairs on small lists."""

import functools
import itertools
import math
import random

import pytest

from wicketflow.operators.similarity import similar_names, similar_names_with_counts


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _names(seed, letters="abc", count=120, longest=14):
    rng = random.Random(seed)
    names = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(count)}
    for name in list(names)[:60]:
        at = rng.randrange(len(name))
        names.add(name[:at] + rng.choice(letters + "Z") + name[at + 1:])
        names.add(name[:at] + name[at + 1:] + "q")
    return sorted(n for n in names if n)


def _score(a, b):
    return 1.0 - _levenshtein(a, b) / max(len(a), len(b))


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.7, 0.6, 0.51])
def test_same_pairs_as_all_pairs(spark, threshold):
    names = _names(int(threshold * 100)) + ["Central Ground, North Town", "Central Ground, South Town", "central ground, north town"]
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "venue string")
    found = {(r.name1, r.name2): r.similarity for r in similar_names(df, "venue", threshold).collect()}
    wanted = {}
    for a, b in itertools.combinations(sorted(set(names)), 2):
        score = _score(a, b)
        if score >= threshold:
            wanted[(a, b)] = score
    assert found.keys() == wanted.keys()
    assert all(found[k] == pytest.approx(wanted[k]) for k in found)


def test_names_that_share_almost_everything(spark):
    """All names share a long start: the shared part must neither hide nor invent pairs."""
    names = [f"customer#{k:06d}" for k in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = {(r.name1, r.name2) for r in similar_names(df, "name", 0.9).collect()}
    wanted = {(a, b) for a, b in itertools.combinations(names, 2) if sum(x != y for x, y in zip(a, b)) == 1}
    assert found == wanted


def test_lower_case_and_counts(spark):
    df = spark.createDataFrame([("Lord Park",), ("LORD PARK",), ("Lord Pack",), ("Lord Park",)], "venue string")
    pairs = {(r.name1, r.name2): r.similarity for r in similar_names(df, "venue", 0.88, lower=True).collect()}
    assert pairs[("LORD PARK", "Lord Park")] == 1.0 and len(pairs) == 3
    counted = similar_names_with_counts(df, "venue", 0.8).collect()
    assert [(r.name1, r.name2, r.count1, r.count2) for r in counted] == [("Lord Pack", "Lord Park", 1, 2)]


def test_threshold_is_checked(spark):
    df = spark.createDataFrame([("a",)], "name string")
    with pytest.raises(ValueError):
        similar_names(df, "name", 0.4)


@pytest.mark.parametrize("size,threshold", [(5, 0.8), (20, 0.6)])
def test_no_hot_key(spark, size, threshold):
    """Short names and low thresholds: pairs that meet stay far below all pairs."""
    from pyspark.sql import functions as F

    from wicketflow.operators.similarity import _signatures

    rng = random.Random(size)
    names = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size)) for _ in range(4000)})
    df = spark.createDataFrame(list(enumerate(names)), "id bigint, text string")
    keys = _signatures(df, threshold, 3).where("len = low AND len = high").groupBy("low", "high", "token").agg(
        F.sum(F.when(F.col("side") != 1, 1).otherwise(0)).alias("a"), F.sum(F.when(F.col("side") != 0, 1).otherwise(0)).alias("b")
    )
    met, largest = keys.agg(F.sum(F.col("a") * F.col("b")), F.max("b")).first()
    assert largest < 0.1 * len(names) and met < 0.35 * len(names) ** 2


def test_keys_carry_no_text_and_grow_with_the_edits(spark):
    from wicketflow.operators.similarity import _signatures

    df = spark.createDataFrame([(k, "".join(random.Random(k).choices("abcdefghij", k=40))) for k in range(50)], "id bigint, text string")
    for threshold, most in ((0.9, 13), (0.8, 25), (0.6, 17 + 153)):
        keys = _signatures(df, threshold, 3)
        assert not any(t == "string" for _, t in keys.dtypes)
        assert keys.count() <= 50 * most


def test_numbered_names_meet_in_proportion(spark):
    """Names that differ in a number alone: what meets grows with the names, not with their square."""
    from pyspark.sql import functions as F

    from wicketflow.operators.similarity import _signatures

    met = {}
    for size in (500, 4000):
        df = spark.createDataFrame([(k, f"customer#{k:09d}") for k in range(size)], "id bigint, text string")
        uses = _signatures(df, 0.9, 3).groupBy("low", "high", "token").agg(F.count("*").alias("n"))
        met[size] = uses.agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    assert met[4000] < 2 * 8 * met[500]


def test_one_edit_between_names_of_any_length(spark):
    names = sorted(set(_names(5, letters="ab", count=300, longest=12)))
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = {(r.name1, r.name2) for r in similar_names(df, "name", 0.88).collect()}
    assert found == {(a, b) for a, b in itertools.combinations(names, 2) if _score(a, b) >= 0.88 - 1e-9}


def _by_sql(names, threshold):
    import duckdb
    import pyarrow as pa

    names = pa.table({"t": names})
    pairs = duckdb.sql("SELECT a.t AS x, b.t AS y, levenshtein(a.t, b.t) AS d, greatest(length(a.t), length(b.t)) AS h FROM names a JOIN names b ON a.t < b.t").fetchall()
    return {(x, y): 1.0 - d / h for x, y, d, h in pairs if 1.0 - d / h > threshold}


def _urls(count):
    rng = random.Random(7)
    ends = ["", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"]
    return sorted({f"https://{rng.choice(['blog.', ''])}site.example.net/{rng.choice(['en', 'de'])}/{rng.randrange(99999)}{rng.choice(ends)}" for _ in range(count)})


def test_names_of_one_kind_are_not_stored_for_each_key(spark, monkeypatch):
    """URLs of a site share their q-grams: what is stored and shuffled are names, not keys and pairs."""
    from wicketflow.operators import edit_blocks, similarity

    stored = []

    def counting(spark, df, keep=similarity.stage):
        stored.append(out := keep(spark, df))
        return out

    monkeypatch.setattr(similarity, "stage", counting)
    monkeypatch.setattr(edit_blocks, "_BLOCK", 150)
    names = _urls(700)
    df = spark.createDataFrame([(n,) for n in names for _ in range(1 + (n < names[99]))], "url string")
    rows = similar_names_with_counts(df, "url", 0.8).collect()
    wanted = _by_sql(names, 0.8)
    assert len(wanted) > 10 * len(names) and len(rows) == len(wanted)
    assert {(r.name1, r.name2): r.similarity for r in rows} == pytest.approx(wanted)
    assert all((r.count1, r.count2) == (1 + (r.name1 < names[99]), 1 + (r.name2 < names[99])) for r in rows)
    assert sum(t.count() for t in stored) <= 3 * len(names)


def test_names_that_share_few_grams_meet_on_keys(spark):
    from wicketflow.operators.similarity import _crowded

    rng = random.Random(3)
    letters = [chr(k) for k in range(40, 120)]
    names = {"".join(rng.choices(letters, k=rng.randint(26, 32))) for _ in range(3000)}
    names = sorted(names | {n[:5] + "!" + n[6:-1] for n in sorted(names)[::20]})
    assert _crowded(spark.createDataFrame(list(enumerate(names)), "id bigint, text string"), 0.8, 3) is None
    found = {(r.name1, r.name2) for r in similar_names(spark.createDataFrame([(n,) for n in names], "t string"), "t", 0.8, strict=True).collect()}
    assert found == _by_sql(names, 0.8).keys() and len(found) >= 150


def test_blocks_of_long_and_odd_strings(spark, monkeypatch):
    from wicketflow.operators import edit_blocks

    monkeypatch.setattr(edit_blocks, "_BLOCK", 40)
    rng = random.Random(11)
    names = ["".join(rng.choices("ab", k=rng.choice([30, 63, 64, 65, 127, 128, 129, 200]))) for _ in range(90)]
    names = sorted({*names, *(n[:20] + "xyz" + n[20:] for n in names), *(n[3:] for n in names)})
    found = {(r.name1, r.name2): r.similarity for r in similar_names(spark.createDataFrame([(n,) for n in names], "t string"), "t", 0.8, strict=True).collect()}
    assert found == pytest.approx(_by_sql(names, 0.8))
    odd = ["", "é", "naïve", "語の名前", "語名前", "\U0001f3cf ball", "ball", "naive", "語" * 70]
    got = [list(d) for d in edit_blocks.Columns(odd).distances(sorted(odd))]
    assert got == [[_levenshtein(a, b) for b in odd] for a in sorted(odd)]


def _edits_allowed(low, high, threshold=0.8):
    return int((1 - threshold) * high + 1e-9) if low else -1


@pytest.mark.parametrize("few,rows,stays", [(64, 1 << 21, 0.9), (3, 1 << 21, 1.0), (64, 500, 0.3)])
def test_bands_of_starts_and_ends(monkeypatch, few, rows, stays):
    """Walked from one end or both, with columns left out early or late: the pairs and distances of all matrices."""
    from wicketflow.operators import edit_blocks

    monkeypatch.setattr(edit_blocks, "_FEW", few)
    monkeypatch.setattr(edit_blocks, "_ROWS", rows)
    monkeypatch.setattr(edit_blocks, "_STAYS", stays)
    rng = random.Random(few)
    many = [chr(k) for k in range(200, 500)]
    texts = ["", *_urls(20), *_names(few, "ab", 20, 20)[:40], *("".join(rng.choices("ab", k=rng.randint(90, 150))) for _ in range(3)), *("".join(rng.choices(many, k=12)) for _ in range(300))][:110]
    texts = sorted([*texts, *texts[:9], *(t[: len(t) // 2] + "x" + t[len(t) // 2 :] for t in texts)])
    columns, far = texts[::-1], functools.cache(_levenshtein)
    for threshold in (0.8, 0.6):
        limit = lambda a, b: _edits_allowed(min(a, b), max(a, b), threshold)
        found = {(k, at): d for k, close, fars in edit_blocks.Columns(columns).near(texts, limit) for at, d in zip(close.tolist(), fars.tolist())}
        wanted = {}
        for (k, a), (at, b) in itertools.product(enumerate(texts), enumerate(columns)):
            if abs(len(a) - len(b)) <= limit(len(a), len(b)) and (d := far(*sorted((a, b)))) <= limit(len(a), len(b)):
                wanted[k, at] = d
        assert found == wanted and len(wanted) > len(texts)


def test_columns_far_from_a_start_are_left_out(monkeypatch):
    """URLs of many sites: most pairs of strings are settled by their first characters, and what strings start or end with alike is done once."""
    from wicketflow.operators import edit_blocks

    rng = random.Random(2)
    sites = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(40)]
    names = sorted({f"https://{rng.choice(sites)}.example.net/{rng.randrange(99999)}{rng.choice(['', '.html', '?utm_source=feed'])}" for _ in range(1500)})
    cells = []

    def counting(self, *given, advance=edit_blocks._Band._advanced):
        cells.append((new := advance(self, *given)).size)
        return new

    monkeypatch.setattr(edit_blocks._Band, "_advanced", counting)
    found = sum(len(close) for _, close, _ in edit_blocks.Columns(names).near(names, lambda a, b: _edits_allowed(min(a, b), max(a, b))))
    assert found == 2 * len(_by_sql(names, 0.8 - 1e-9)) + len(names)
    assert sum(cells) < 0.06 * sum(len(a) for a in names) * sum(len(b) for b in names)


def test_equal_texts_of_crowded_names(spark, monkeypatch):
    """In lower case names are alike; each pair comes once, the lesser name first with its rows, and blocks share no pair."""
    from wicketflow.operators import edit_blocks

    monkeypatch.setattr(edit_blocks, "_BLOCK", 90)
    monkeypatch.setattr(edit_blocks, "_PAIRS", 500)
    urls = _urls(160)
    names = sorted({*urls, *(u.upper() for u in urls[::3]), *(u.title() for u in urls[::5]), "ab", "aB", "abcdefghi", "abcdefghj"})
    rows = [(n,) for n in names for _ in range(1 + len(n) % 3)]
    found = similar_names(spark.createDataFrame(rows, "t string"), "t", 0.8, lower=True, counts=True).collect()
    wanted = {(a, b): s for a, b in itertools.combinations(names, 2) if (s := _score(a.lower(), b.lower())) >= 0.8}
    assert {(r.name1, r.name2): r.similarity for r in found} == pytest.approx(wanted) and len(found) == len(wanted)
    assert all((r.count1, r.count2) == (1 + len(r.name1) % 3, 1 + len(r.name2) % 3) for r in found)


def test_rounding_is_that_of_round(spark):
    from pyspark.sql import functions as F

    from wicketflow.plans.catalogue import _six_places

    rng = random.Random(8)
    numbers = [None, 0.0, -0.0, math.nan, math.inf, -math.inf, 1e300, -1e300, 5e-7, -5e-7, 1.5e-6, 0.1234565, -0.1234565, 99999.9999995, 123456.1234565, -1e-7, 4.35e15]
    numbers += [1.0 - d / n for n in range(1, 60) for d in range(n)] + [k / 2**21 for k in range(-300, 300)]
    numbers += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 9) for _ in range(3000)] + [round(rng.uniform(-9, 9), 6) + 5e-7 for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    told = df.select(F.col("x").cast("string"), _six_places(F.col("x")).cast("string").alias("a"), F.round("x", 6).cast("string").alias("b"))
    assert [r for r in told.collect() if r.a != r.b] == []


def test_blocks_do_not_shrink_with_the_partitions(spark, monkeypatch):
    """More ranges than asked for: neighbours go together, so names are dealt to as many blocks as their number takes."""
    from wicketflow.operators import edit_blocks

    assert edit_blocks._numbers([(k, 10) for k in range(12)], 40) == [(k, k // 4) for k in range(12)]
    assert edit_blocks._numbers([(0, 3), (2, 500), (3, 1), (5, 1)], 40) == [(0, 0), (2, 1), (3, 2), (5, 2)] and edit_blocks._numbers([], 9) == []
    monkeypatch.setattr(edit_blocks, "_LEAST", 100)
    monkeypatch.setattr(edit_blocks, "_BLOCK", 100)
    monkeypatch.setattr(edit_blocks, "_RANGES", 50)
    names = _urls(300)
    df = spark.createDataFrame([(k, n, n, 1) for k, n in enumerate(names)], "id bigint, name string, text string, n bigint")
    pairs = edit_blocks.near_pairs(df, lambda low, high: int(0.2 * high + 1e-9), 1)
    assert {(r.name1, r.name2) for r in pairs.collect()} == _by_sql(names, 0.8 - 1e-9).keys()
