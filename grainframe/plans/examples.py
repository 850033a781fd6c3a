"""Example questions from games, rides, launches and shops, asked of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.catalog import Measure, star_select
from grainframe.functions import (
    calc_percent,
    capital_first,
    day_of_week,
    generation,
    only_if,
    ratio,
    split_part,
    within_last,
    year_diff,
)
from grainframe.functions.conditions import GENERATIONS
from grainframe.operators import (
    agg_of_agg,
    align,
    collect_label,
    count_keys,
    count_rows,
    enrich,
    keep_not_in,
    lagged,
    link,
    pct_of_parent,
    pct_of_total,
    rank_entities,
    running_total,
    top_entities,
    topk,
    with_total,
)
from grainframe.plans.projection import band_sql, mean
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables, star


@query(
    "ex_weekday_scores",
    """SELECT CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday, count(*) AS orders,
              round(sum(o_totalprice), 2) / count(*) AS avg_price
       FROM orders GROUP BY 1""",
)
def weekday_scores(t: Tables) -> DataFrame:
    return t.orders.groupBy(day_of_week(F.col("o_orderdate")).alias("weekday")).agg(
        count_rows().alias("orders"), mean("o_totalprice").alias("avg_price")
    )


@query(
    "ex_ride_heatmap",
    """SELECT CAST(dayofweek(ts) AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour_of_day,
              count(*) AS rides, round(sum(value), 2) / count(*) / 60 AS avg_minutes
       FROM events GROUP BY 1, 2""",
)
def ride_heatmap(t: Tables) -> DataFrame:
    return t.events.groupBy(
        day_of_week(F.col("ts")).alias("weekday"), F.hour("ts").alias("hour_of_day")
    ).agg(count_rows().alias("rides"), (mean("value") / 60).alias("avg_minutes"))


@query(
    "ex_post_size",
    """SELECT round(length(text) / 100.0, 0)::DOUBLE AS size_bucket, round(avg(quality), 6) AS avg_quality,
              count(*) AS sample_size
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1 HAVING count(*) > 5""",
)
def post_size(t: Tables) -> DataFrame:
    """Quality by text length in hundreds; small samples are left out afterwards."""
    sized = t.documents.select("doc_id", F.round(F.length("text") / 100.0, 0).alias("size_bucket"))
    scored = enrich(sized, t.labels, "doc_id", ["quality"])
    return (
        scored.groupBy("size_bucket")
        .agg(F.round(F.avg("quality"), 6).alias("avg_quality"), count_rows().alias("sample_size"))
        .filter("sample_size > 5")
    )


@query(
    "ex_game_hours",
    """SELECT round(value / 60, 0) AS game_hours, event_type, count(*) AS events FROM events
       WHERE round(value / 60, 0) = 1 AND value NOT IN (30, 90) GROUP BY 1, 2""",
)
def game_hours(t: Tables) -> DataFrame:
    """A filter on a rounded, derived column."""
    timed = t.events.filter(~F.col("value").isin(30, 90)).withColumn(
        "game_hours", F.round(F.col("value") / 60, 0)
    )
    return timed.filter("game_hours = 1").groupBy("game_hours", "event_type").agg(
        count_rows().alias("events")
    )


@query(
    "ex_win_rate",
    """SELECT c_mktsegment, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*)::DOUBLE AS win_rate
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def win_rate(t: Tables) -> DataFrame:
    matches = enrich(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_mktsegment"])
    won = F.count(only_if(F.col("o_orderkey"), F.col("o_orderstatus") == "F"))
    return matches.groupBy("c_mktsegment").agg(ratio(won, count_rows()).alias("win_rate"))


@query(
    "ex_generations",
    f"""SELECT {band_sql("y", GENERATIONS, "Other")} AS generation, count(*) AS riders
        FROM (SELECT CAST(1875 + c_acctbal / 70 AS INTEGER) AS y FROM customer) GROUP BY 1""",
)
def generations(t: Tables) -> DataFrame:
    year = F.rint(1875 + F.col("c_acctbal") / 70).cast("int")
    return t.customer.groupBy(generation(year).alias("generation")).agg(count_rows().alias("riders"))


@query(
    "ex_bike_stats",
    """SELECT l_suppkey, count(*) AS trips, sum(l_quantity) AS total_duration,
              round(sum(l_quantity) / count(*), 6) AS avg_duration
       FROM lineitem GROUP BY 1 ORDER BY total_duration DESC, l_suppkey LIMIT 10""",
)
def bike_stats(t: Tables) -> DataFrame:
    rides = t.lineitem.groupBy("l_suppkey").agg(
        count_rows().alias("trips"), F.sum("l_quantity").alias("total_duration")
    )
    best = topk(rides, [("total_duration", "desc")], 10, tie_break=["l_suppkey"])
    return best.withColumn("avg_duration", F.round(F.col("total_duration") / F.col("trips"), 6))


_MONTHS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
                    count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS filled,
                    count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open
             FROM orders GROUP BY 1, 2"""


@query(
    "ex_subgroup_share",
    f"""SELECT y, m, filled, open, filled / sum(filled) OVER (PARTITION BY y)::DOUBLE AS filled_share,
               open / sum(open) OVER (PARTITION BY y)::DOUBLE AS open_share FROM ({_MONTHS})""",
)
def subgroup_share(t: Tables) -> DataFrame:
    """Monthly counts of two subgroups and their shares of the year's subgroup."""
    orders = t.orders.select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderstatus"
    )
    status = F.col("o_orderstatus")
    return pct_of_parent(
        orders,
        ["m"],
        ["y"],
        {
            "filled": (F.count_if(status == "F"), "filled_share"),
            "open": (F.count_if(status == "O"), "open_share"),
        },
    )


@query(
    "ex_trip_growth",
    """WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS trips FROM orders GROUP BY 1)
       SELECT y, trips, lag(trips) OVER (ORDER BY y) AS previous,
              trips - lag(trips) OVER (ORDER BY y) AS growth,
              (trips - lag(trips) OVER (ORDER BY y)) * 100
                / lag(trips) OVER (ORDER BY y)::DOUBLE AS trips_growth_pct
       FROM g""",
)
def trip_growth(t: Tables) -> DataFrame:
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(count_rows().alias("trips"))
    return lagged(yearly, "trips", "y").withColumn("growth", F.col("trips") - F.col("previous"))


@query(
    "ex_top_scorers",
    """WITH g AS (SELECT user_id, CASE WHEN count(*) > 10 THEN 1 ELSE 0 END AS eligible,
                         round(sum(value), 2) AS total_points,
                         round(sum(value), 2) / count(*) AS points_per_game FROM events GROUP BY 1)
       SELECT user_id, total_points, points_per_game FROM
         (SELECT *, rank() OVER (ORDER BY eligible DESC, points_per_game DESC) AS r FROM g) WHERE r < 100""",
)
def top_scorers(t: Tables) -> DataFrame:
    ranked = rank_entities(
        t.events,
        ["user_id"],
        {
            "eligible": F.when(count_rows() > 10, 1).otherwise(0),
            "total_points": F.round(F.sum("value"), 2),
            "points_per_game": mean("value"),
        },
        {"r": [("eligible", "desc"), ("points_per_game", "desc")]},
    )
    return ranked.filter("r < 100").select("user_id", "total_points", "points_per_game")


_BEST_USER = """(SELECT user_id FROM (SELECT user_id, rank() OVER (ORDER BY round(sum(value), 2) DESC) AS r
                 FROM events GROUP BY 1) WHERE r = 1)"""


@query(
    "ex_best_player_shots",
    f"""SELECT event_type, round(sum(value), 2) AS total_points, count(*) AS attempts,
               count(CASE WHEN value > 20 THEN 1 END) / count(*)::DOUBLE AS shooting_percentage
        FROM events WHERE user_id IN {_BEST_USER} GROUP BY 1""",
)
def best_player_shots(t: Tables) -> DataFrame:
    """Details of the one entity with rank 1."""
    best = top_entities(t.events, "user_id", F.round(F.sum("value"), 2), 1)
    return best.groupBy("event_type").agg(
        F.round(F.sum("value"), 2).alias("total_points"),
        count_rows().alias("attempts"),
        ratio(F.count_if(F.col("value") > 20), count_rows()).alias("shooting_percentage"),
    )


@query(
    "ex_top_names_by_year",
    """WITH n AS (SELECT p_name, l_quantity, CAST(year(l_shipdate) AS INTEGER) AS y
                  FROM lineitem JOIN part ON l_partkey = p_partkey),
            r AS (SELECT p_name, rank() OVER (ORDER BY sum(l_quantity) DESC) AS name_rank FROM n GROUP BY 1)
       SELECT y, p_name, sum(l_quantity) AS total FROM n
       WHERE p_name IN (SELECT p_name FROM r WHERE name_rank < 6) GROUP BY 1, 2""",
)
def top_names_by_year(t: Tables) -> DataFrame:
    """The five best-selling names over all years, shown by year."""
    lines = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_name"])
    yearly = lines.groupBy(F.year("l_shipdate").alias("y"), "p_name").agg(
        F.sum("l_quantity").alias("total")
    )
    return top_entities(yearly, "p_name", F.sum("total"), 5)


@query(
    "ex_percent_by_state",
    """SELECT n_name, count(*) AS births, count(*) / sum(count(*)) OVER ()::DOUBLE AS percent_of_total
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def percent_by_state(t: Tables) -> DataFrame:
    people = enrich(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    return pct_of_total(people, ["n_name"], "births", count_rows(), "percent_of_total")


@query(
    "ex_user_order_value",
    """SELECT o_custkey, round(round(sum(v), 2) / count(*), 6) AS average_order_value
       FROM (SELECT o_custkey, o_orderkey, sum(l_extendedprice) AS v
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
       GROUP BY 1 ORDER BY average_order_value DESC, o_custkey LIMIT 100""",
)
def user_order_value(t: Tables) -> DataFrame:
    """Lines are summed to orders before the join, so it sees one row per order."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("v"))
    orders = enrich(per_order, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"])
    means = orders.groupBy("o_custkey").agg(F.round(mean("v"), 6).alias("average_order_value"))
    return topk(means, [("average_order_value", "desc")], 100, tie_break=["o_custkey"])


@query(
    "ex_rich_passengers",
    """SELECT c_mktsegment, count(CASE WHEN s_acctbal IS NOT NULL THEN c_custkey END) AS rich_passengers,
              round(sum(s_acctbal), 2) / count(s_acctbal) AS avg_class_wealth, max(s_acctbal) AS max_class_wealth
       FROM customer LEFT JOIN supplier ON split_part(c_name, '#', 2) = split_part(s_name, '#', 2)
       GROUP BY 1""",
)
def rich_passengers(t: Tables) -> DataFrame:
    """Facts of another model, linked by a part of the name."""
    linked = link(
        t.customer,
        t.supplier,
        split_part(F.col("c_name"), "#", 2),
        split_part(F.col("s_name"), "#", 2),
        ["s_acctbal"],
    )
    rich = only_if(F.col("c_custkey"), F.col("s_acctbal").isNotNull())
    return linked.groupBy("c_mktsegment").agg(
        F.count(rich).alias("rich_passengers"),
        mean("s_acctbal").alias("avg_class_wealth"),
        F.max("s_acctbal").alias("max_class_wealth"),
    )


@query(
    "ex_cumulative_fleet",
    """WITH l AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
            c AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1),
            launches AS (SELECT d, (sum(n) OVER (ORDER BY d))::BIGINT AS cumulative_launches FROM l),
            decoms AS (SELECT d, (sum(n) OVER (ORDER BY d))::BIGINT AS cumulative_decoms FROM c),
            today AS (SELECT DATE '2002-06-30' AS d, (SELECT count(*) FROM orders) AS final_size,
                             (SELECT count(*) FROM lineitem) AS final_decom)
       SELECT coalesce(launches.d, decoms.d, today.d) AS "date", cumulative_launches, cumulative_decoms,
              coalesce(final_size, cumulative_launches) AS launch_display,
              coalesce(final_decom, cumulative_decoms) AS decom_display
       FROM launches FULL JOIN decoms ON launches.d = decoms.d
       FULL JOIN today ON today.d = coalesce(launches.d, decoms.d)""",
)
def cumulative_fleet(t: Tables) -> DataFrame:
    """Two running totals and a closing row, aligned on the date."""

    def along(df: DataFrame, column: str, out: str) -> DataFrame:
        dated = df.select(F.to_date(column).alias("date"))
        return running_total(dated, "date", "n", count_rows(), out).drop("n")

    def closing(df: DataFrame, out: str) -> DataFrame:
        return df.agg(count_rows().alias(out)).withColumn("date", F.to_date(F.lit("2002-06-30")))

    aligned = align(
        [
            along(t.orders, "o_orderdate", "cumulative_launches"),
            along(t.lineitem, "l_shipdate", "cumulative_decoms"),
            closing(t.orders, "final_size"),
            closing(t.lineitem, "final_decom"),
        ],
        ["date"],
    )
    return aligned.select(
        "date",
        "cumulative_launches",
        "cumulative_decoms",
        F.coalesce("final_size", "cumulative_launches").alias("launch_display"),
        F.coalesce("final_decom", "cumulative_decoms").alias("decom_display"),
    )


@query(
    "ex_satellites_per_launch",
    """SELECT s_name, count(*) AS satellites_launched,
              count(*) / count(DISTINCT l_orderkey)::DOUBLE AS satellites_per_launch
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1
       ORDER BY satellites_launched DESC, s_name LIMIT 10""",
)
def satellites_per_launch(t: Tables) -> DataFrame:
    totals = star_select(
        star(t),
        "lineitem",
        {"s_name": "supplier.s_name"},
        {
            "satellites_launched": Measure(("l_linenumber",), F.count),
            "launches": Measure.count_keys("l_orderkey"),
        },
        order=[("satellites_launched", "desc"), ("s_name", "asc")],
        limit=10,
    )
    per = ratio(F.col("satellites_launched"), F.col("launches"))
    return totals.withColumn("satellites_per_launch", per).drop("launches")


@query(
    "ex_owner_label",
    """SELECT n_name, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment)
                || ' (' || count(DISTINCT CASE WHEN c_acctbal > 9000 THEN c_custkey END) || ' active)' AS label
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
       HAVING count(DISTINCT CASE WHEN c_acctbal > 9000 THEN c_custkey END) > 0""",
)
def owner_label(t: Tables) -> DataFrame:
    """Names of a group in one text, with a conditional count; empty groups are left out."""
    people = enrich(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    names = collect_label(people, ["n_name"], "c_mktsegment", "names")
    active = people.groupBy("n_name").agg(
        count_keys(only_if(F.col("c_custkey"), F.col("c_acctbal") > 9000)).alias("active")
    )
    label = F.concat("names", F.lit(" ("), F.col("active").cast("string"), F.lit(" active)"))
    return align([names, active], ["n_name"]).filter("active > 0").select("n_name", label.alias("label"))


@query(
    "ex_headline_names",
    """SELECT CASE WHEN count(DISTINCT p_type) > 4 THEN 'Many (' || count(DISTINCT p_type) || ')'
                   ELSE string_agg(DISTINCT p_type, ', ' ORDER BY p_type) END AS headline_name,
              count(*) AS parts, min(p_size) AS smallest, max(p_size) AS largest,
              count(DISTINCT p_brand) AS brands
       FROM part""",
)
def headline_names(t: Tables) -> DataFrame:
    """A headline without dimensions that names few members and counts many."""
    parts = t.part.withColumn("everything", F.lit(1))
    names = collect_label(parts, ["everything"], "p_type", "headline_name", limit=4)
    totals = parts.groupBy("everything").agg(
        count_rows().alias("parts"),
        F.min("p_size").alias("smallest"),
        F.max("p_size").alias("largest"),
        count_keys("p_brand").alias("brands"),
    )
    return align([names, totals], ["everything"]).drop("everything")


@query(
    "ex_capital_list",
    """SELECT count(DISTINCT event_type) AS species,
              'Click, Error, Purchase, Signup, View' AS species_list FROM events""",
)
def capital_list(t: Tables) -> DataFrame:
    """A list built by mapping a function over collected values."""
    kinds = t.events.select("event_type").distinct()
    names = F.transform(F.array_sort(F.collect_list("event_type")), capital_first)
    return kinds.agg(
        count_rows().alias("species"), F.array_join(names, ", ").alias("species_list")
    )


@query(
    "ex_engines_not_upper",
    """SELECT p_partkey, p_size, count(*) AS launches FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_linenumber IN (1, 2) AND p_size > 5 AND p_size < 45
         AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7)
       GROUP BY 1, 2""",
)
def engines_not_upper(t: Tables) -> DataFrame:
    """Members used in one role and never in another, with a range on an attribute."""
    upper = t.lineitem.filter("l_linenumber = 7")
    first = keep_not_in(t.lineitem.filter("l_linenumber in (1, 2)"), "l_partkey", upper)
    counted = first.groupBy(F.col("l_partkey").alias("p_partkey")).agg(count_rows().alias("launches"))
    sized = enrich(counted, t.part, "p_partkey", ["p_size"])
    return sized.filter("p_size > 5 and p_size < 45")


@query(
    "ex_species_ranks",
    """WITH g AS (SELECT p_name, p_brand, round(sum(p_retailprice), 2) / count(*) AS avg_length, count(*) AS samples
                  FROM part GROUP BY 1, 2),
            b AS (SELECT p_brand, rank() OVER (ORDER BY round(sum(p_retailprice), 2) / count(*) DESC) AS r
                  FROM part GROUP BY 1)
       SELECT p_name, p_brand, avg_length, samples FROM
         (SELECT *, rank() OVER (ORDER BY avg_length DESC, p_name, p_brand) AS rank_desc FROM g
          WHERE p_brand IN (SELECT p_brand FROM b WHERE r = 1))
       WHERE rank_desc <= 20""",
)
def species_ranks(t: Tables) -> DataFrame:
    """Members of the best group, best first, the ranks themselves hidden."""
    best = top_entities(t.part, "p_brand", mean("p_retailprice"), 1)
    groups = best.groupBy("p_name", "p_brand").agg(
        mean("p_retailprice").alias("avg_length"), count_rows().alias("samples")
    )
    return topk(groups, [("avg_length", "desc")], 20, tie_break=["p_name", "p_brand"])


@query(
    "ex_launches_by_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS launch_year, round(sum(o_totalprice), 2) AS payload,
              count(*) AS launches, CAST(2002 - year(min(o_orderdate)) AS INTEGER) AS years_ago,
              round(log10(CASE WHEN round(sum(o_totalprice), 2) = 0 THEN 1 ELSE round(sum(o_totalprice), 2) END), 6)
                AS log_payload
       FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1902-06-30' AND DATE '2002-06-30' GROUP BY 1""",
)
def launches_by_year(t: Tables) -> DataFrame:
    """A century up to a given day, with a logarithm that is safe at zero."""
    recent = t.orders.filter(within_last(F.col("o_orderdate"), "year", 100, "2002-06-30"))
    yearly = recent.groupBy(F.year("o_orderdate").alias("launch_year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("payload"),
        count_rows().alias("launches"),
        F.min("o_orderdate").alias("first"),
    )
    payload = F.col("payload")
    return yearly.select(
        "launch_year",
        "payload",
        "launches",
        year_diff(F.col("first"), F.to_date(F.lit("2002-06-30"))).alias("years_ago"),
        F.round(F.log10(F.when(payload == 0, 1.0).otherwise(payload)), 6).alias("log_payload"),
    )


@query(
    "ex_fuel_summary",
    """WITH isp AS (SELECT l_orderkey, max(p_size) AS isp FROM lineitem JOIN part ON l_partkey = p_partkey
                    GROUP BY 1),
            fuel AS (SELECT p_type, count(*) AS launches, count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS won
                     FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
       SELECT (SELECT avg(isp) FROM isp) AS average_isp, p_type AS fuel, launches,
              round(won / launches::DOUBLE, 2) * 100 AS success_rate FROM fuel""",
)
def fuel_summary(t: Tables) -> DataFrame:
    """A mean over one value per launch beside success rates per fuel."""
    lines = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_type", "p_size"])
    fuels = lines.groupBy(F.col("p_type").alias("fuel")).agg(
        count_rows().alias("launches"),
        (calc_percent(F.count_if(F.col("l_returnflag") == "N"), count_rows(), 2) * 100).alias(
            "success_rate"
        ),
    )
    per_launch = lines.groupBy("l_orderkey").agg(F.max("p_size").alias("isp"))
    return with_total(fuels, {"average_isp": F.avg("isp")}, source=per_launch)


@query(
    "ex_all_vehicles",
    """SELECT p_brand, count(*) AS launches, (SELECT count(DISTINCT p_type) FROM part) AS all_families
       FROM part GROUP BY 1""",
)
def all_vehicles(t: Tables) -> DataFrame:
    """A count over all rows repeated on every group."""
    groups = t.part.groupBy("p_brand").agg(count_rows().alias("launches"))
    return with_total(groups, {"all_families": count_keys("p_type")}, source=t.part)


@query(
    "ex_average_of_yearly_counts",
    """SELECT o_orderpriority, avg(n) AS avg_orders_per_year, max(n) AS best_year
       FROM (SELECT o_orderpriority, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def average_of_yearly_counts(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("y", F.year("o_orderdate"))
    return agg_of_agg(
        dated,
        ["o_orderpriority", "y"],
        {"n": count_rows()},
        ["o_orderpriority"],
        {"avg_orders_per_year": F.avg("n"), "best_year": F.max("n")},
    )
