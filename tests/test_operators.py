"""Operators that SQL does not express, and edge cases."""

from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.functions.formula import with_formula
from gridloom.functions.predicates import compile_filter, criterion, wildcard
from gridloom.operators import documents, drawing, entities


def test_filter_order_of_tests(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("1d",), ("NaN",), ("",), (None,), ("x5",)], "v string")
    hits = lambda t: [r.v for r in df.where(compile_filter(t, df.v)).collect()]
    assert hits("=5") == ["5"]
    assert hits("==5") == ["5", "5.0"]
    assert hits(">= 0") == ["5", "5.0"]
    assert hits("∅") == ["", None]
    assert hits("!∅") == ["5", "5.0", "1d", "NaN", "x5"]
    assert hits("^x") == ["x5"] and hits('"=5"') == []


def test_criteria_and_wildcards(spark):
    df = spark.createDataFrame([("abc",), ("a?c",), ("ABD",), ("7",)], "v string")
    n = lambda c: df.agg(F.count_if(criterion(c, df.v))).first()[0]
    assert (n("ab?"), n("a~?c"), n("<>ab*"), n(">6")) == (2, 1, 2, 1)
    assert wildcard("a*") == "(?is)^a.*$"


def test_natural_key_keeps_long_digit_runs(spark):
    k = lambda s: spark.range(1).select(text.natural_key(F.lit(s))).first()[0]
    assert k("A2") < k("A10") and k("A007") == k("a7") and len(k("1" * 20)) == 20


def test_ipv4_of_signed_integer(spark):
    assert spark.range(1).select(text.ipv4(F.lit(-1062731775)), text.ipv4(F.lit(-1))).first()[:] == ("192.168.0.1", None)


def test_osa_counts_transpositions_and_caps(spark):
    df = spark.createDataFrame([("abcd", "abdc"), ("abc", "abc"), ("abc", "xyz"), (None, "a"), ("ca", "abc")], "a string, b string")
    assert [r[0] for r in df.select(entities.osa_distance(df.a, df.b, 2)).collect()] == [1, 0, 3, None, 3]


def test_lcs_with_equal_gaps(spark):
    a = spark.createDataFrame([(1, i, c) for i, c in enumerate("axc")], "k long, o long, l string")
    b = spark.createDataFrame([(1, i, c) for i, c in enumerate("ayc")], "k long, o long, l string")
    got = sorted(tuple(r) for r in entities.lcs_pairs(a, b, "k", "o", "l").collect())
    assert got == [(1, 0, 0, "label"), (1, 1, 1, "gap"), (1, 2, 2, "label")]


def test_both_sides_of_one_table_under_a_projection(spark):
    from gridloom.operators.selection import ordered_assignment

    t = spark.createDataFrame([(k, i, c) for k, w in enumerate(["abc", "abd", "xbd"]) for i, c in enumerate(w)], "k long, o long, l string")
    got = entities.lcs_pairs(t, t.select((t.k - 1).alias("k"), "o", "l"), "k", "o", "l").select("how", "j", "i", "k").collect()
    assert sorted((r.k, r.i, r.j, r.how) for r in got) == [(0, 0, 0, "label"), (0, 1, 1, "label"), (0, 2, 2, "gap"), (1, 0, 0, "gap"), (1, 1, 1, "label"), (1, 2, 2, "label")]
    y = t.select("k", t.o.cast("double").alias("y"))
    assert {(r.k, r.i, r.j) for r in ordered_assignment(y.where("y > 0"), y.where("y < 2"), "k", "y", 5.0).select("j", "i", "k").collect()} == {(k, i, i) for k in range(3) for i in (0, 1)}


def test_overlap_is_measured_against_kept_boxes_only(spark):
    boxes = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 0.0, 0.0, 9.0, 9.0), (1, 3, 8.5, 8.5, 12.5, 12.5)], "page long, id long, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.id for r in entities.drop_overlaps(boxes, "page", 0.5).collect()) == [1, 3]


def test_positional_audit_numbers_whole_tables(spark):
    left, right = spark.range(0, 3000, 3).withColumnRenamed("id", "a"), spark.range(0, 2700, 3).withColumnRenamed("id", "b").where("b <> 2400").repartition(3)
    got = sorted((tuple(r) for r in entities.positional(left.repartition(5), right, "a", "b").collect()), key=lambda r: r[0])
    others = [3 * i for i in range(900) if i != 800] + [None] * 101
    want = [(i + 1, 3 * i, b, "right missing" if b is None else "same" if b == 3 * i else "differs") for i, b in enumerate(others)]
    assert got == want
    plan = entities.numbered(left, "a", "i")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan  # no task gets all rows
    assert [tuple(r) for r in entities.positional(left.limit(0), right.where("b = 0"), "a", "b").collect()] == [(1, None, 0, "left missing")]


def test_registered_audit_and_tiers_take_whole_tables(spark):
    from gridloom.plans import registry

    t = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    q = registry.queries()
    audit = q["positional_audit"](spark, "/root/testdata/sf0.01")
    assert audit.count() == max(t("orders").count(), t("customer").count())
    tiers = q["two_tier_match"](spark, "/root/testdata/sf0.01")
    assert tiers.select("p_partkey").distinct().count() == t("part").count() and tiers.select("match").distinct().count() == t("supplier").count()


def test_registered_fallback_match_takes_all_certificates(spark):
    from gridloom.plans import registry

    got = {r.cert for r in registry.queries()["unique_fallback_match"](spark, "/root/testdata/sf0.1").where("rule = 'tag'").collect()}
    suppliers = {r[0] for r in spark.read.parquet("/root/testdata/sf0.1/supplier.parquet").select("s_suppkey").collect()}
    assert got == {i for i in suppliers if i % 2 == 0} and max(got) > 300


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_union_keeps_keys_together(spark):
    from pyspark.sql import functions as F

    from gridloom.session import safe_unions

    safe_unions(spark)
    part = lambda n: spark.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(n))
    got = part(0).unionByName(part(1)).groupBy("k").agg(F.count(F.lit(1)).alias("sides")).collect()
    assert sorted((r.k, r.sides) for r in got) == [(k, 2) for k in range(7)]


def test_ordered_assignment_is_the_cheapest(spark):
    import itertools
    import random

    from gridloom.operators.selection import ordered_assignment

    rng, skip = random.Random(3), 4.0
    left = [(k, float(rng.randrange(30))) for k in range(12) for _ in range(rng.randrange(1, 5))]
    right = [(k, float(rng.randrange(30))) for k in range(12) for _ in range(rng.randrange(0, 5))]
    got = {}
    for r in ordered_assignment(spark.createDataFrame(left, "k int, y double"), spark.createDataFrame(right, "k int, y double"), "k", "y", skip).collect():
        got.setdefault(r.k, []).append((r.i, r.j))
    for k in range(12):
        x, y = sorted(v for q, v in left if q == k), sorted(v for q, v in right if q == k)
        cost = lambda p: sum(abs(x[i] - y[j]) for i, j in p) + skip * (len(x) - len(p))
        ways = (tuple(zip(a, b, strict=True)) for n in range(min(len(x), len(y)) + 1) for a in itertools.combinations(range(len(x)), n) for b in itertools.combinations(range(len(y)), n))
        mine = sorted(got.get(k, []))
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(mine))
        assert cost(mine) == min(map(cost, ways))


def test_chains_stop_at_loops_and_forks(spark):
    from gridloom.operators.selection import chains

    links = spark.createDataFrame([("a", "b", "x"), ("b", "c", "y"), ("b", "d", "z"), ("c", "a", "w")], "a string, b string, kind string")
    got = {("".join(r.path), "".join(r.kinds), r.ends) for r in chains(spark.createDataFrame([("a",), ("q",)], "node string"), links, 5).collect()}
    assert got == {("abc", "xy", "loop"), ("abd", "xz", "end"), ("q", "", "end")}
    assert {r.ends for r in chains(spark.createDataFrame([("a",)], "node string"), links, 1).collect()} == {"cut"}


def test_same_end(spark):
    from gridloom.operators.selection import same_end

    rows = [("10BFA01-GS001-X1", "10BFA01-GS001.X1", True), ("10BFA01-X1", "10BFA01-GS001-X1", True), ("10BFA01-GS001", "10BFA02-GS001", False), ("10BFA01-A", "10BFA01-B", False), ("10BFA01-", "10BFA01-B", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert [r.got for r in df.select(same_end(df["a"], df["b"]).alias("got")).collect()] == [r[2] for r in rows]


def test_formulas_keep_blanks_and_errors_apart(spark):
    from gridloom.functions.formula import with_formula

    df = spark.createDataFrame([(1, "x", None), (2, None, 4.0), (3, "7", 0.0)], "a int, b string, c double")
    wants = {
        "=C1+A1": [1.0, 6.0, 3.0],
        "=A1/C1": [None, 0.5, None],
        '=IFERROR(A1/C1,"none")': ["none", "0.5", "none"],
        "=B1*2": [None, 0.0, 14.0],
        '=B1&"|"&C1': ["x|", "|4", "7|0"],
        "=ISBLANK(B1)": [False, True, False],
        "=ISERROR(A1/C1)": [True, False, True],
        "=-2^2": [4.0] * 3,
        "=10%*A1": [0.1, 0.2, 0.3],
        '=A1<"a"': [True] * 3,
        '=B1=""': [False, True, False],
        '=IF(AND(A1>1,C1=0),"yes","no")': ["no", "no", "yes"],
        '=MID("abcdef",A1,2)': ["ab", "bc", "cd"],
        '=SUBSTITUTE("a-b-c","-","+",2)': ["a-b+c"] * 3,
        '=SEARCH("C?","abcd")': [3.0] * 3,
        '=SUM(A:A)-COUNTIF(B:B,"x")': [5.0] * 3,
        "=COUNTA(B:B)": [2.0] * 3,
        "=DATE(2024,14,A1)-DATE(2025,2,1)": [0.0, 1.0, 2.0],
    }
    for f, want in wants.items():
        got = [r.v for r in with_formula(df, "v", f).orderBy("a").collect()]
        assert all(w == g or (isinstance(w, float) and g is not None and abs(w - g) < 1e-9) for w, g in zip(want, got, strict=True)), (f, got)


def test_formats(spark):
    from pyspark.sql import functions as F

    from gridloom.functions.formats import display

    rows = [(1234567.891, "#,##0.00", "1,234,567.89"), (0.5, ".##", ".5"), (0.125, "0.0%", "12.5%"), (-3.0, "0;(0)", "(3)"), (0.0, '0;-0;"nil"', "nil"), (1234567.0, '0,.0"k"', "1234.6k"), (7.0, "000", "007"), (2.50, "0.0#", "2.5"), (-0.001, "0.0", "0.0"), (45292.75, "yyyy-mm-dd hh:mm", "2024-01-01 18:00"), (45292.5, "m/d", "1/1"), (12.5, "General", "12.5"), (1e-4, "", "0.0001")]
    for x, f, want in rows:
        assert spark.range(1).select(display(F.lit(x), f, "number").alias("v")).first().v == want, (x, f)


def test_page_hits_bounds_and_quotes(spark):
    pages = spark.createDataFrame([(1, 1, 3, "see ab-1x and AB-12"), (2, 1, 1, "AB-1"), (3, 1, 3, "xAB-1 AB-1_z"), (4, 1, 3, None), (5, 1, 3, "s/n 7\\Eq."), (6, 1, 3, "")], "doc long, page int, trust int, text string")
    terms = spark.createDataFrame([(1, "AB-1", "tag"), (2, "ab-1", "serial"), (3, "7\\Eq", "serial"), (4, None, "tag"), (5, "--", "tag")], "entity long, term string, kind string")
    got = sorted((r.entity, r.doc, r.exact) for r in documents.page_hits(pages, terms).collect())
    assert got == [(1, 1, False), (1, 3, False), (2, 2, True), (2, 3, False), (3, 5, True)]
    assert documents.page_hits(pages, terms.limit(0)).count() == 0


def test_labels_follow_reading_direction(spark):
    box = "page long, id long, dir int, x0 double, y0 double, x1 double, y1 double, text string"
    flat = [(1, 1, 0, 0.0, 0.0, 30.0, 10.0, "S"), (1, 2, 0, 0.0, 11.0, 30.0, 21.0, "E"), (1, 3, 0, 40.0, 0.0, 60.0, 10.0, "E"), (1, 4, 0, 500.0, 0.0, 520.0, 10.0, "E")]
    # page 2 is page 1 turned by a quarter, so that texts run down and the next line is to the left
    turned = [(2, i, 1, -y1, x0, -y0, x1, t) for _, i, _, x0, y0, x1, y1, t in flat]
    got = drawing.merged_labels(spark.createDataFrame(flat + turned, box), F.col("text") == "S", F.col("text") == "E").collect()
    assert sorted((r.page, r.id, r.first_id, r.label, r.form) for r in got) == [(p, i, 1, "SE", f) for p in (1, 2) for i, f in ((2, "stacked"), (3, "inline"))]


def test_lookup_of_a_missing_key_is_an_error(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "y")], "k string, v string")
    out = with_formula(df, "f", '=IFERROR(INDEX(A:A,MATCH(B2,A:A,0)),"no")')
    assert {r.f for r in out.collect()} == {"no"} and out.count() == 3


def test_oem_signals_and_units_as_written(spark):
    from gridloom.operators.resolvers import resolve_oem

    index = spark.createDataFrame([("96QV2", "valve", "G"), ("20FG1", "gas valve", None)], "key string, entity string, scope string")
    signals = spark.createDataFrame([("96QV", "a", "G"), ("CTDA1", "b", None), ("AFPAP", "c", "S"), ("A1B", "d", None)], "key string, entity string, scope string")
    asked = ["96QV", "96QV.PV", "G11.96qv", "GT12S 96QV", "G12S 96QV", "S1.afpap", "SAMP1.afpap.PV.Value", "G11.afpap", "ctda1", "a1_b", "ctda1 ctda1", "GT11 20FG-1", "S10_96QV-2", "S30_9020FG1"]
    got = {(r.q, r.entity, r.via, r.unit) for r in resolve_oem(spark.createDataFrame([(q,) for q in asked], "q string"), index, None, signals).collect()}
    assert got == {("G11.96qv", "a", "signal", "G11"), ("G12S 96QV", "a", "signal", "G12"), ("S1.afpap", "c", "signal", "S10"), ("SAMP1.afpap.PV.Value", "c", "signal", "S10"),
                   ("ctda1", "b", "signal", ""), ("a1_b", "d", "signal", ""), ("GT11 20FG-1", "gas valve", "unit", "G11"), ("S30_9020FG1", "gas valve", "90", "S30")}
