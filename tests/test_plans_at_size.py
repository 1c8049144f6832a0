"""Work that must be done once a row, and joins that must read few columns, by the plans."""

import math
import random
import re
import struct
from pathlib import Path

from pyspark.sql import functions as F

from delaykit import constants as K
from delaykit.functions import codes
from delaykit.operators import cleaning, enrichment, mentions, models, splitting, trees
from delaykit.plans import CATALOG
from delaykit.plans.catalog import rounded
from delaykit.plans.flight_queries import enriched
from delaykit.plans.model_queries import _training_parts
from delaykit.session import shared_root
from delaykit.sources import testdata as data

PATH = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_payload_is_parsed_once(spark):
    assert plan(mentions.flatten_itineraries(data.payloads(spark, PATH))).count("from_json(") == 1


def test_flights_are_dealt_out_once_for_their_order(spark):
    flights = plan(data.flights(spark, PATH))
    # The customer is joined to the orders, below the join of the line items.
    joins = [line for line in flights.splitlines() if re.search(r"Join LeftOuter", line)]
    depth = {key: line.index("Join") for line in joins for key in ("o_custkey", "l_orderkey") if key in line}
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_codes_are_trimmed_without_patterns(spark):
    odd = spark.createDataFrame([(" \t\n\x0b\f\ra b\r\f\x0b\n\t ",), ("\n",), ("",), (None,), ("x",)], "c string")
    found = odd.select(codes.strip(F.col("c")).alias("c"), F.regexp_replace("c", r"^\s+|\s+$", "").alias("wanted"))
    assert [r["c"] for r in found.collect()] == [r["wanted"] for r in found.collect()] == ["a b", "", "", None, "x"]
    assert "regexp_replace" not in plan(cleaning.clean_flights(data.dirty_flights(spark, PATH)))


def test_texts_are_parsed_once_and_numbers_are_filtered_below_the_joins(spark):
    raw = plan(cleaning.filter_hub_routes(cleaning.clean_flights(data.dirty_flights(spark, PATH)), data.HUBS))
    assert raw.count("RLIKE(DEP_DELAY") == 1 and not re.search(r"Filter .*RLIKE", raw)
    lines = plan(cleaning.clean_flights(data.flights(spark, PATH))).splitlines()
    assert lines.index(next(x for x in lines if "Filter" in x and "l_quantity" in x)) > max(
        i for i, x in enumerate(lines) if "Join LeftOuter" in x and "l_orderkey" in x
    )


def test_one_hot_encoding_joins_the_flights_once(spark):
    # The rows are written before their labels are numbered, so the result reads no line items.
    hot = CATALOG["one_hot_encode"].plain(spark, PATH)
    assert "l_orderkey" not in plan(hot)


def test_the_gated_model_and_its_lookups_share_the_report(spark, monkeypatch):
    made, delay_cause = [], data.delay_cause
    monkeypatch.setattr(data, "delay_cause", lambda *args: made.append(1) or delay_cause(*args))
    monkeypatch.setitem(models.FORESTS, "airport_month", trees.Rules(trees=2, depth=2))
    assert CATALOG["score_gated_model"].plain(spark, PATH).count() == data.requests(spark, PATH).count()
    assert len(made) == 1


def test_flights_to_learn_from_are_written_wide_once(spark):
    folder = Path(shared_root(spark)) / "settled"
    known = set(folder.glob("*"))
    train, test = _training_parts(spark, PATH)
    written = [spark.read.parquet(str(p)).columns for p in set(folder.glob("*")) - known]
    assert len([c for c in written if K.HISTORY_DEST[0] in c]) == 1
    # The same parts as from flights that were enriched before they were split.
    parts = splitting.temporal_split(enriched(spark, PATH))
    for name, part in (("train", train), ("test", test)):
        wanted = parts.where(F.col("split") == name).groupBy("ORIGIN", "DEST", "OP_CARRIER", "DISTANCE", "DEP_DELAY", *K.HISTORY_DEST[:1])
        found = part.groupBy("ORIGIN", "DEST", "OP_CARRIER", "DISTANCE", "DEP_DELAY", *K.HISTORY_DEST[:1])
        assert sorted(map(repr, found.count().collect())) == sorted(map(repr, wanted.count().collect()))
    # The means by key are written, so that their size is known before the flights are dealt out.
    assert "Aggregate" not in plan(enrichment.target_encode_join(train))


def test_doubles_are_rounded_as_before_and_as_one_list(spark):
    draw = random.Random(3)
    odd = [None, 0.0, -0.0, 1e-9, -1e-9, 0.0078125, -0.0078125, 2.5e-6, 0.1234565, 1.0000005, -3.4999995, 999999.9999995,
           1e6, 1e12 + 0.1, 123456789.1234565, 1e17, -1e300, math.inf, -math.inf, math.nan, 5e-324]
    odd += [draw.uniform(-1, 1) * 10 ** draw.randint(-8, 9) for _ in range(2000)]
    odd += [round(draw.uniform(-1e5, 1e5), 6) + 5e-7 for _ in range(2000)] + [draw.randint(-(10**9), 10**9) / 128 for _ in range(2000)]
    df = spark.createDataFrame([(x, i, x) for i, x in enumerate(odd)], "`a.b` double, i long, c double")
    bits = lambda x: None if x is None else "nan" if math.isnan(x) else struct.pack("d", x)
    for digits in (4, 6):
        wanted = df.select(F.round("`a.b`", digits), "i", F.round("c", digits)).collect()
        assert rounded(df, digits).columns == df.columns
        assert [[bits(r[0]), r[1], bits(r[2])] for r in rounded(df, digits).collect()] == [[bits(r[0]), r[1], bits(r[2])] for r in wanted]
    # One rounding for all of the columns.
    assert len(re.findall(r"\bround\(", plan(rounded(df)))) == 1
