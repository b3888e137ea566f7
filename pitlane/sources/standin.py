"""Stand-in raw race tables derived from the TPC-H-style test tables.

The real season files are not available, so each raw source table is
re-expressed over the test warehouse (orders, lineitem, customer, supplier,
nation, region, events), in the raw contract's camelCase names with every
column as text and '\\N' as the missing marker, exactly like the source CSVs.
Everything grows with the input tables: one race per order day, one result
per line item, one driver per customer, one team and one circuit per nation,
pit stops and laps from the event stream. Each frame carries ``_seq``, the
source order that "keep first" dedupes by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlane.operators.order import placed

NULL = "\\N"
#: Result ids start above 2**53, where doubles no longer tell neighbours apart.
RESULT_ID_BASE = 9007199254740992
HIGHLIGHTED = ("Hamilton", "Vettel", "Alonso", "Rosberg")
EPOCH = "1995-01-01"
# Era used with the stand-in data (order dates run 1995-01-01 .. 2001-08-01).
STANDIN_ERA = (1996, 2024)


def _s(c: Column) -> Column:
    return c.cast("string")


def _lit_null() -> Column:
    return F.lit(NULL)


def read_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def with_repeats(df: DataFrame, when: Column, changed: str) -> DataFrame:
    """The rows and, later in source order, changed copies of some: what "keep first" is for."""
    late = df.where(when).withColumns({changed: F.concat(F.col(changed), F.lit(" (again)")),
                                       "_seq": F.col("_seq") + 10 ** 12})
    return df.unionByName(late)


def _race_id(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit(EPOCH).cast("date")) + F.lit(1)


def race_days(orders: DataFrame) -> DataFrame:
    """One row per order day: (race_id, d, year, month). Calendar-sized."""
    d = orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.select(_race_id(F.col("d")).cast("long").alias("race_id"), "d",
                    F.year("d").cast("long").alias("year"), F.month("d").cast("long").alias("month"))


def result_lines(t: dict[str, DataFrame]) -> DataFrame:
    """Line items joined to their order and supplier, with typed helper columns."""
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_quantity", "l_returnflag", "l_linestatus")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    pos_num = F.lit(1) + F.col("l_partkey") % 20
    year = F.year(F.col("o_orderdate").cast("date"))
    won = (F.col("l_returnflag") != "R") & (pos_num == 1)
    # Every third season one driver wins all, every third four drivers share the wins.
    driver = (F.when(won & (year % 3 == 0), F.lit(1)).when(won & (year % 3 == 1), F.col("o_custkey") % 4 + 1)
              .otherwise(F.col("o_custkey")))
    return j.select(
        (F.lit(RESULT_ID_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("result_id"),
        _race_id(F.col("o_orderdate")).cast("long").alias("race_id"),
        F.year(F.col("o_orderdate").cast("date")).cast("long").alias("year"),
        F.month(F.col("o_orderdate").cast("date")).cast("long").alias("month"),
        driver.cast("long").alias("driver_id"),
        F.col("s_nationkey").cast("long").alias("constructor_id"),
        F.col("l_linenumber").cast("long").alias("grid"),
        F.when(F.col("l_returnflag") == "R", F.lit("R")).otherwise(_s(pos_num)).alias("position"),
        F.when(F.col("l_returnflag") == "R", F.lit(21)).otherwise(pos_num).cast("long").alias("position_order"),
        F.col("l_quantity").cast("long").alias("qty"),
        "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
    ).transform(with_seq)


def with_seq(lines: DataFrame) -> DataFrame:
    """``_seq``: the order of repeated result ids; rows equal in all of it are equal altogether."""
    return lines.withColumn("_seq", F.struct("l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"))


def races_raw(t: dict[str, DataFrame]) -> DataFrame:
    days = race_days(t["orders"])
    # A calendar has at most 366 days per season, so this window is bounded.
    rnd = F.row_number().over(Window.partitionBy("year").orderBy("d"))
    cols = {
        "raceId": _s(F.col("race_id")), "year": _s(F.col("year")), "round": _s(rnd),
        "circuitId": _s(F.col("race_id") % 25),
        "name": F.concat(F.lit("Race "), _s(F.col("race_id"))),
        "date": _s(F.col("d")), "time": _lit_null(),
        "url": F.concat(F.lit("race/"), _s(F.col("race_id"))),
    }
    for s in ("fp1", "fp2", "fp3", "quali", "sprint"):
        cols[f"{s}_date"] = _lit_null()
        cols[f"{s}_time"] = _lit_null()
    races = days.select(*[c.alias(k) for k, c in cols.items()], F.col("race_id").alias("_seq"))
    return with_repeats(races, F.col("_seq") % 50 == 0, "name")


def results_raw(lines: DataFrame) -> DataFrame:
    rid, form = _s(F.col("result_id")), F.col("l_suppkey") % 3  # one id in several spellings
    return lines.select(
        F.when(form == 0, F.concat(F.lit("0"), rid)).when(form == 1, F.concat(rid, F.lit(".0"))).otherwise(rid)
        .alias("resultId"), _s(F.col("race_id")).alias("raceId"),
        F.when(F.col("l_partkey") % 101 == 0, _lit_null()).otherwise(_s(F.col("driver_id"))).alias("driverId"),
        _s(F.col("constructor_id")).alias("constructorId"),
        _s(F.col("driver_id") % 100).alias("number"), _s(F.col("grid")).alias("grid"),
        F.col("position").alias("position"), F.col("position").alias("positionText"),
        _s(F.col("position_order")).alias("positionOrder"), _s(F.col("qty")).alias("points"),
        _s(F.lit(50) + F.col("l_suppkey") % 20).alias("laps"), _lit_null().alias("time"),
        _s(F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("milliseconds"),
        _s(F.lit(40) + F.col("grid")).alias("fastestLap"), _s(F.col("grid")).alias("rank"),
        _lit_null().alias("fastestLapTime"), _lit_null().alias("fastestLapSpeed"),
        _s(F.ascii("l_returnflag") * 100 + F.ascii("l_linestatus")).alias("statusId"),
        "_seq")


def sprint_results_raw(lines: DataFrame) -> DataFrame:
    return results_raw(lines.where(F.col("grid") == 1)).drop("rank", "fastestLapSpeed")


def drivers_raw(t: dict[str, DataFrame]) -> DataFrame:
    c = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    dob = F.date_add(F.lit("1970-01-01").cast("date"), (k % 10000).cast("int"))
    return c.select(
        _s(k).alias("driverId"), F.concat(F.lit("drv_"), _s(k)).alias("driverRef"),
        F.when(k % 3 == 0, _lit_null()).otherwise(_s(k % 100)).alias("number"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("code"),
        F.lit("Driver").alias("forename"),
        F.when(k % 7 == 0, F.element_at(F.array(*map(F.lit, HIGHLIGHTED)), (k % len(HIGHLIGHTED) + 1).cast("int")))
        .otherwise(F.col("c_name")).alias("surname"),
        F.when(k % 50 == 0, F.lit("unknown")).otherwise(_s(dob)).alias("dob"),
        F.col("n_name").alias("nationality"),
        F.concat(F.lit("drivers/"), _s(k)).alias("url"), k.alias("_seq"))


def _nations(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))


def constructors_raw(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("n_nationkey")
    return _nations(t).select(
        _s(k).alias("constructorId"), F.lower("n_name").alias("constructorRef"),
        F.col("n_name").alias("name"), F.col("r_name").alias("nationality"),
        F.concat(F.lit("constructors/"), F.lower("n_name")).alias("url"),
        k.cast("long").alias("_seq"))


def circuits_raw(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("n_nationkey")
    return _nations(t).select(
        _s(k).alias("circuitId"), F.concat(F.lower("n_name"), F.lit("_circuit")).alias("circuitRef"),
        F.concat(F.lit("Circuit "), F.col("n_name")).alias("name"),
        F.col("n_name").alias("location"), F.col("r_name").alias("country"),
        _s(k * 2 - 25).alias("lat"), _s(k * 7 - 90).alias("lng"),
        F.when(k % 4 == 0, _lit_null()).otherwise(_s(k * 10)).alias("alt"),
        F.concat(F.lit("circuits/"), F.lower("n_name")).alias("url"),
        k.cast("long").alias("_seq")).transform(with_repeats, F.col("_seq") % 5 == 0, "name")


def _standings(t: dict[str, DataFrame], lines: DataFrame, entity: str,
               id_name: str, entity_name: str) -> DataFrame:
    """Standings after the last race of each half season (snap 1) and season (snap 2).

    Points and wins are sums over the results up to that race; the position
    is the order by points (desc) then entity id, found by range partitioning,
    so a season never sits in one task.
    """
    days = race_days(t["orders"])
    last = days.groupBy("year").agg(
        F.max(F.when(F.col("month") <= 6, F.col("race_id"))).alias("last1"),
        F.max("race_id").alias("last2"))
    win = (F.col("position") == "1").cast("long")
    agg1 = lines.where(F.col("month") <= 6).groupBy("year", entity).agg(
        F.sum("qty").alias("pts"), F.sum(win).alias("wins")).withColumn("snap", F.lit(1))
    agg2 = lines.groupBy("year", entity).agg(
        F.sum("qty").alias("pts"), F.sum(win).alias("wins")).withColumn("snap", F.lit(2))
    both = agg1.unionByName(agg2)
    ranked = placed(both, [F.desc("pts"), F.asc(entity)], ["year", "snap"], out="pos")
    ranked = ranked.join(last, "year")
    rid = F.when(F.col("snap") == 1, F.col("last1")).otherwise(F.col("last2"))
    sid = F.col(entity) * 100000 + F.col("year") * 10 + F.col("snap")  # snapshots stay under 100,000
    return ranked.select(
        _s(sid).alias(id_name), _s(rid).alias("raceId"), _s(F.col(entity)).alias(entity_name),
        _s(F.col("pts")).alias("points"), _s(F.col("pos")).alias("position"),
        _s(F.col("pos")).alias("positionText"), _s(F.col("wins")).alias("wins"),
        sid.alias("_seq")).transform(with_repeats, F.col("_seq") % 100000 % 20 == 2, "positionText")


def driver_standings_raw(t, lines) -> DataFrame:
    return _standings(t, lines, "driver_id", "driverStandingsId", "driverId")


def constructor_standings_raw(t, lines) -> DataFrame:
    return _standings(t, lines, "constructor_id", "constructorStandingsId", "constructorId")


def qualifying_raw(lines: DataFrame) -> DataFrame:
    """One qualifying row per (race, driver): the entry with the lowest result id."""
    # What ``_seq`` holds, or fixes (``qty`` is its quantity), need not go along a second time.
    first = lines.groupBy("race_id", "driver_id").agg(
        F.min(F.struct("result_id", "_seq", "constructor_id", "grid")).alias("f"))
    f = {c: F.col("f").getField(c) for c in ("result_id", "constructor_id", "grid")}
    f |= {c: F.col("f").getField("_seq").getField(c) for c in ("l_linestatus", "l_partkey", "l_quantity")}
    f["qty"] = f.pop("l_quantity").cast("long")
    again = F.when(f["l_partkey"] % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    lap = F.concat(_s(F.lit(1) + f["constructor_id"] % 2), F.lit(":"),
                   F.lpad(_s(f["qty"] + 5), 2, "0"), F.lit("."),
                   F.lpad(_s(f["l_partkey"] % 1000), 3, "0"))
    # Some entries qualify twice under ids of their own: the fact's join then fans out.
    first = first.withColumn("again", F.explode(again))
    qid = f["result_id"] * 2 + F.col("again")
    return first.select(
        _s(qid).alias("qualifyId"), _s(F.col("race_id")).alias("raceId"),
        _s(F.col("driver_id")).alias("driverId"), _s(f["constructor_id"]).alias("constructorId"),
        _s(F.col("driver_id") % 100).alias("number"),
        _s(F.lit(1) + (f["l_partkey"] * 7) % 20).alias("position"),
        F.when(f["l_partkey"] % 97 == 0, F.lit("1:02:03.456")).otherwise(lap).alias("q1"),
        F.when(f["l_linestatus"] == "F", _lit_null()).otherwise(lap).alias("q2"),
        F.when((f["l_linestatus"] == "F") | (f["grid"] > 3), _lit_null()).otherwise(lap).alias("q3"),
        F.struct(qid.alias("a"), F.col("driver_id").alias("b")).alias("_seq"),
    ).where(f["l_partkey"] % 29 != 0)  # and some have none


def _event_ms(value: Column) -> Column:
    return F.floor(value * F.lit(1000.0) + F.lit(0.5)).cast("long")


def pit_stops_raw(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    v = _event_ms(F.col("value"))
    fine = F.floor(F.col("value") * F.lit(10000.0) + F.lit(0.5)).cast("long")  # finer than milliseconds
    txt = F.concat(_s(F.floor(fine / 10000)), F.lit("."), F.lpad(_s(fine % 10000), 4, "0"))
    return e.select(
        _s(F.lit(1) + F.col("event_id") % 2400).alias("raceId"), _s(F.col("user_id")).alias("driverId"),
        _s(F.lit(1) + F.expr("event_id div 1000") % 4).alias("stop"),
        _s(F.lit(1) + F.col("event_id") % 70).alias("lap"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.when(F.col("value") > 100, F.concat(F.lit("1:"), txt)).otherwise(txt).alias("duration"),
        _s(v).alias("milliseconds"), F.col("event_id").alias("_seq"))


def lap_times_raw(t: dict[str, DataFrame]) -> DataFrame:
    e = t["events"]
    return e.select(
        _s(F.lit(1) + F.col("event_id") % 2400).alias("raceId"), _s(F.col("user_id")).alias("driverId"),
        _s(F.col("event_id")).alias("lap"), _s(F.lit(1) + F.col("event_id") % 20).alias("position"),
        F.date_format("ts", "m:ss.SSS").alias("time"), _s(_event_ms(F.col("value"))).alias("milliseconds"),
        F.col("event_id").alias("_seq"))


def status_raw(t: dict[str, DataFrame]) -> DataFrame:
    li = t["lineitem"].select("l_returnflag", "l_linestatus").distinct()
    sid = F.ascii("l_returnflag") * 100 + F.ascii("l_linestatus")
    return li.select(_s(sid).alias("statusId"),
                     F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("status"),
                     sid.cast("long").alias("_seq")).transform(with_repeats, F.col("_seq") % 2 == 0, "status")


def constructor_results_raw(lines: DataFrame) -> DataFrame:
    g = lines.groupBy("race_id", "constructor_id").agg(F.sum("qty").alias("pts"))
    cid = F.col("constructor_id") * 1000000 + F.col("race_id")
    return g.select(_s(cid).alias("constructorResultsId"), _s(F.col("race_id")).alias("raceId"),
                    _s(F.col("constructor_id")).alias("constructorId"), _s(F.col("pts")).alias("points"),
                    _lit_null().alias("status"), cid.alias("_seq"))


def seasons_raw(t: dict[str, DataFrame]) -> DataFrame:
    y = race_days(t["orders"]).select("year").distinct()
    return y.select(_s(F.col("year")).alias("year"),
                    F.concat(F.lit("seasons/"), _s(F.col("year"))).alias("url"), F.col("year").alias("_seq"))


SOURCE_TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]
