"""Ordered scans with large groups cut into slices, against brute force."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from waybill.operators.duplicates import duplicate_findings, duplicate_runs
from waybill.operators.sequences import consecutive_repeats, sequence_groups
from waybill.operators.slices import SkewRule, hot_groups, position_of, time_position, with_rank, with_slice
from waybill.plans.audit import AuditOptions, audit_courses, audit_lines, audit_stops

FORCED = SkewRule(share=0.005, min_rows=10, min_bytes=0)
SCHEMA = "archive_id string, grp string, seq int, rec_no long, code int, name string"


def skewed_rows(seed, n=4000, seqs=50, null_group=False):
    """A third of the rows in one group, some of it with few sequence numbers."""
    rng = random.Random(seed)
    rows = []
    for rec in range(n):
        hot = rng.random() < 0.4
        group = ("hot" if not null_group else None) if hot else f"g{rng.randrange(300)}"
        rows.append(("a", group, rng.randrange(seqs), rec, rng.choice([None, 1, 2]), f"n{rec}"))
    rng.shuffle(rows)
    return rows


def grouped(rows):
    key = lambda r: (r[0], r[1] or "", r[2], r[3])
    for _, members in groupby(sorted(rows, key=key), key=lambda r: (r[0], r[1])):
        yield list(members)


def expected_repeats(rows):
    out = set()
    for members in grouped(rows):
        for before, row in zip(members, members[1:]):
            if row[2] > before[2] and row[4] == before[4]:
                out.add((row[3], before[5]))
    return out


@pytest.mark.parametrize("seqs", [3, 50, 100000])
@pytest.mark.parametrize("null_group", [False, True])
def test_repeats(spark, seqs, null_group):
    rows = skewed_rows(seqs, seqs=seqs, null_group=null_group)
    df = spark.createDataFrame(rows, SCHEMA)
    keys, order, spot = ["archive_id", "grp"], ["seq", "rec_no"], position_of(F.col("seq"), F.col("rec_no"))
    hot = hot_groups(df, keys, spot, FORCED)
    sizes = with_slice(df, keys, spot, hot).where("_hot").groupBy("_slice").count()
    assert sizes.count() > 50 and sizes.agg(F.max("count")).first()[0] < 100
    expected = expected_repeats(rows)
    for cuts in (None, hot):
        found = consecutive_repeats(df, keys, order, "seq", "code", {"prev": "name"}, position=spot, hot=cuts)
        assert {(r.rec_no, r.prev) for r in found.collect()} == expected
        groups = sequence_groups(df, keys, order, "seq", position=spot, hot=cuts)
        counted = {r.grp: (r.rows, r.groups) for r in groups.collect()}
        assert counted == {
            m[0][1]: (len(m), 1 + sum(b[2] >= a[2] for b, a in zip(m, m[1:]))) for m in grouped(rows)
        }


def test_one_sequence_number_only(spark):
    rows = [("a", "hot", 5, i, 1, f"n{i}") for i in range(3000)] + [("a", "hot", 6, 3000, 1, "last")]
    df = spark.createDataFrame(rows, SCHEMA)
    keys, spot = ["archive_id", "grp"], position_of(F.col("seq"), F.col("rec_no"))
    hot = hot_groups(df, keys, spot, FORCED)
    found = consecutive_repeats(df, keys, ["seq", "rec_no"], "seq", "code", {"prev": "name"}, position=spot, hot=hot)
    assert [(r.rec_no, r.prev) for r in found.collect()] == [(3000, "n2999")]


@pytest.mark.parametrize("n", [2, 63, 64, 65, 1000, 4096])
def test_slices_follow_the_order(spark, n):
    """Slice numbers rise with the position and are about even, for any number of cuts."""
    df = spark.range(20000).selectExpr("1 as grp", "(id * 7919) % 20000 as seq")
    spot = position_of(F.col("seq"))
    hot = hot_groups(df, ["grp"], spot, SkewRule(share=1 / n, min_rows=1, min_bytes=0))
    rows = with_slice(df, ["grp"], spot, hot).orderBy("seq").select("_slice").toPandas()["_slice"]
    assert rows.is_monotonic_increasing and abs(rows.nunique() - n) <= max(2, n / 2)
    assert rows.value_counts().max() <= 2.5 * 20000 / n + 20


def test_rows_of_one_edit_stamp_spread_over_slices(spark):
    """The cuts fall between later order columns where the first ones are the same throughout."""
    stamp = F.lit("2021-05-04 10:00:00.123456").cast("timestamp_ntz")
    df = spark.range(20000).select(F.lit(1).alias("grp"), stamp.alias("edited"), F.lit(7).alias("seq"), ((F.col("id") * 7919) % 20000).alias("rec_no"))
    spot = position_of(time_position(F.col("edited")), F.col("seq"), F.col("rec_no"))
    hot = hot_groups(df, ["grp"], spot, SkewRule(share=0.01, min_rows=1, min_bytes=0))
    sizes = with_slice(df, ["grp"], spot, hot).groupBy("_slice").count().toPandas()["count"]
    assert len(sizes) > 80 and sizes.max() < 500
    ranked = with_rank(df, ["grp"], ["edited", "seq", "rec_no"], "k", spot, hot)
    assert ranked.where("k <> rec_no + 1").count() == 0 and ranked.count() == 20000


def test_positions_follow_microseconds_and_nulls(spark):
    stamps = [None, "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "1970-01-01 00:00:00.000001", "0001-01-01 00:00:00"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, s string")
    rows = df.select("i", time_position(F.col("s").cast("timestamp_ntz")).alias("at")).collect()
    assert {r.i: r["at"] for r in rows} == {0: None, 1: -1, 2: 0, 3: 1, 4: -62135596800000000}
    assert [r.i for r in df.orderBy(position_of(F.col("s").cast("timestamp_ntz"), F.col("i"))).collect()] == [0, 4, 1, 2, 3]


def test_any_number_of_large_groups_is_cut(spark):
    df = spark.range(200_000).selectExpr("id % 5000 as grp", "id as seq")
    spot = position_of(F.col("seq"))
    hot = hot_groups(df, ["grp"], spot, SkewRule(share=1 / 20_000, min_rows=1, min_bytes=0))
    assert hot.count() == 5000
    sizes = with_slice(df, ["grp"], spot, hot).groupBy("grp", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    ranked = with_rank(df, ["grp"], ["seq"], "k", spot, hot)
    assert ranked.where("k <> (seq div 5000) + 1").count() == 0 and ranked.count() == 200_000


def test_rank(spark):
    rows = skewed_rows(7)
    df = spark.createDataFrame(rows, SCHEMA)
    spot = position_of(F.col("rec_no"))
    hot = hot_groups(df, ["grp"], spot, FORCED)
    ranked = {r.rec_no: r.k for r in with_rank(df, ["grp"], ["rec_no"], "k", spot, hot).collect()}
    for members in grouped(rows):
        assert [ranked[r] for r in sorted(m[3] for m in members)] == list(range(1, len(members) + 1))


def test_small_inputs_are_not_sliced(spark):
    df = spark.range(5000).selectExpr("id % 5 as grp", "id as seq")
    assert hot_groups(df, ["grp"], position_of(F.col("seq")), SkewRule()) is None


def test_even_groups_are_not_hot(spark):
    df = spark.range(5000).selectExpr("id % 500 as grp", "id as seq")  # ten rows in each group
    assert hot_groups(df, ["grp"], position_of(F.col("seq")), FORCED) is None


@pytest.mark.parametrize("mode", ["member", "cumulative", "group"])
def test_duplicates(spark, mode):
    rng = random.Random(3)
    rows = [("a", "hot" if rng.random() < 0.4 else f"g{rng.randrange(800)}", f"c{rng.randrange(2)}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "archive_id string, name string, code string, rec_no long").repartition(7)
    keys = ["archive_id", "name"]
    plain, cut = [
        duplicate_findings(df, keys, "name", "code", mode=mode, skew=skew)
        for skew in (SkewRule(), FORCED)
    ]
    assert plain.columns == cut.columns
    found = sorted(map(tuple, plain.collect()))
    assert found == sorted(map(tuple, cut.collect()))
    expected = []
    for name in {r[1] for r in rows}:
        codes = [(r[2], r[3]) for r in rows if r[1] == name]
        texts = [f"[{name}] [{c}]" for c, _ in codes]
        n = len(codes)
        if n < 2:
            continue
        same = codes[0][0] == codes[1][0]
        if mode == "group":
            expected.append(("a", name, n, codes[0][1], codes[0][0], n, n - 1, same, f"{texts[0]}, {texts[1]}"))
            continue
        for k in range(2, n + 1):
            listed = ", ".join(texts[:k]) if mode == "cumulative" else f"{texts[0]}, {texts[k - 1]}"
            expected.append(("a", name, k, codes[k - 1][1], codes[k - 1][0], n, 1, same, listed))
    assert found == sorted(expected)


def physical_plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_runs_limit_rows_before_the_shuffle(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    plan = physical_plan(duplicate_runs(part, ["p_size", "p_name"], "p_name", "p_brand", "p_partkey"))
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_sliced_join_serves_the_window(spark, sf_dir):
    """One shuffle of the rows for both the join and the ordered scan, and the same result."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = driver.line_consecutive_stops(spark, sf_dir, SkewRule(share=0.0001, min_rows=5, min_bytes=0))
        plan = physical_plan(cut)
        # Rows once and the edges of hot groups once, each by slice and key; the edges' chain by key.
        assert plan.count("Exchange hashpartitioning(_slice") == 2
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        plain = driver.line_consecutive_stops(spark, sf_dir)
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sliced_join_with_a_hot_key(spark, tmp_path, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.when(F.col("l_partkey") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("l_orderkey"))
    lines = lines.withColumns(
        {"l_orderkey": key, "l_linenumber": F.col("l_partkey").cast("int"), "l_suppkey": F.col("l_suppkey") % 3}
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("o_orderdate", F.expr("timestamp_ntz'1999-01-01'")).write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    cut, plain = [driver.line_consecutive_stops(spark, str(tmp_path), r) for r in (FORCED, SkewRule(min_bytes=1 << 50))]
    found = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, cut.collect())) == found and any(r[0] == 7 for r in found)


def test_audits_agree_when_sliced(spark):
    rng = random.Random(11)
    plain, cut = AuditOptions(), AuditOptions(skew=FORCED)
    stops = spark.createDataFrame(
        [("a", i, "X" if rng.random() < 0.4 else f"s{rng.randrange(400)}", f"{rng.randrange(500)}", "A", "1", "1") for i in range(2000)],
        "archive_id string, rec_no long, NAZWA string, KOD2 string, SYM string, X_KRAJ string, Y_KRAJ string",
    )
    lines = spark.createDataFrame(
        [("a", i, "2", "1", str(i), "1", None, None) for i in range(100)],
        "archive_id string, rec_no long, STATLINII string, NRF string, NRLINII string, WARLINII string, WAZNAOD date, WAZNADO date",
    )
    routes = spark.createDataFrame(
        [
            ("a", i, "1", str(0 if rng.random() < 0.4 else rng.randrange(120)), "1", None, str(rng.randrange(90)), str(rng.randrange(3)), "n")
            for i in range(3000)
        ],
        "archive_id string, rec_no long, NRF string, NRLINII string, WARLINII string, WAZNAOD date, NRPRZYST string, KOD2 string, NAZPRZYST string",
    )
    courses = lines.selectExpr(
        "archive_id", "rec_no", "STATLINII as STATKURSU", "NRF", "NRLINII as NRKURSU", "WARLINII as WARIANT", "WAZNAOD as WAZNYOD",
        "WAZNADO as WAZNYDO",
    )
    trips = routes.selectExpr(
        "archive_id", "rec_no", "NRF as NRFK", "NRLINII as NRKURSU", "WARLINII as WARIANT", "WAZNAOD as WAZNYOD", "NRPRZYST",
        "KOD2", "NAZPRZYST", "date'2024-01-01' as DATAOP", "concat(rec_no % 24, ':15') as GODZOP",
    )
    edit = dict(course_order="edit_ts")

    def as_numbers(df):
        return df.selectExpr(*[f"cast({c} as int) as {c}" if c[:3] in ("NRF", "NRL", "WAR", "NRK") else c for c in df.columns])

    for make in (
        lambda o: audit_stops(stops, o),
        lambda o: audit_lines(lines, routes, None, o),
        lambda o: audit_lines(as_numbers(lines), as_numbers(routes), None, o),
        lambda o: audit_courses(courses, trips, None, o),
        lambda o: audit_courses(as_numbers(courses), as_numbers(trips), None, o),
        lambda o: audit_courses(courses, trips, None, AuditOptions(skew=o.skew, **edit)),
    ):
        one, two = [sorted(map(tuple, make(o).findings.collect()), key=repr) for o in (plain, cut)]
        assert one == two and one
