"""The reference inputs derived from the test tables, on Spark.

``checks/tables_sql.py`` states the same tables in SQL.  All rows of the tables
take part; what a job's own day filter leaves out is the job's business.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.functions import hash32, pad_array
from paddock.operators.filters import int_ids
from paddock.operators.joins import lookup_join
from paddock.plans import items as item_plans
from paddock.plans import names as N
from paddock.plans import users as user_plans
from paddock.plans.daily import Inputs
from paddock.plans.samples import impression_labels, label_events, train_samples
from paddock.session import shared_dir, tune
from paddock.sources import scan_dictionary

RUN = "2024-01-27"
SNAP = "2024-01-26"
ACTIONS = {"view": "beseen", "click": "click", "error": "quick_collection", "purchase": "bid"}
#: Dictionary versions and their seeds: one in 16 values of all items, by hash, is left out as unknown.
VERSIONS = {"2024-06-04": "old", N.DICTIONARY_VERSION: "new"}
#: Before the first item: the daily job gives every item its features.
MIN_CREATE = "2023"
PRICE_TIES = ("o", "l", "x")
WINDOWS = {"0_3": (0, 2), "0_7": (0, 6), "7_14": (7, 13), "14_30": (14, 29), "0_30": (0, 29),
           "0_365": (0, 364)}

# dictionary name -> attribute of the priced item
DICTIONARY_ATTRIBUTES = {
    **{d: a for a, _, d in N.ITEM_SPARSE},
    "evaluate_level": "evaluate_level", "car_level": "car_level",
    "c2b_evaluate_level_segment": "evaluate_level_segment",
}


#: Rows of the log whose counts one task works out: each becomes one per later day, and those one per category.
ROWS_A_TASK = 10_000


def ratio(num, den):
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


_WRITTEN: dict = {}


class Tables:
    """Inputs of one scale folder.  Tables that other jobs would have filled are
    written once per session to the shared folder and read from there."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = tune(spark), sf_dir

    def stored(self, name: str, build, by=()) -> DataFrame:
        app = self.spark.sparkContext.applicationId
        key = (app, self.dir, name)
        if key not in _WRITTEN:
            folder = f"{shared_dir(self.spark)}/{app}-{abs(hash(self.dir))}/{name}"
            df = build()
            if by:  # one folder per value, a large one in several files
                df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(folder)
            else:
                df.write.mode("overwrite").parquet(folder)
            _WRITTEN[key] = (folder, df.schema)
        folder, schema = _WRITTEN[key]
        return self.spark.read.schema(schema).parquet(folder)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def behaviour(self) -> DataFrame:
        """The log, stored by day as a log is."""
        return self.stored("behaviour", self._behaviour, by=("dt",))

    def _behaviour(self) -> DataFrame:
        ev = self.read("events")
        hour, day = F.hour("ts"), F.dayofmonth("ts")
        page = F.when(hour < 2, "SEARCH_INVITATION").when(hour < 5, "GRAB").otherwise("SEARCH")
        action = F.lit("order")
        for event, name in ACTIONS.items():
            action = F.when(F.col("event_type") == event, name).otherwise(action)
        seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
        return ev.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.regexp_extract("props", r"([0-9]+)", 1).alias("clue_id"),
            F.concat_ws("-", F.col("user_id").cast("string"),
                        F.floor((day - 1) / 7).cast("string")).alias("recommend_id"),
            (day % 3).cast("string").alias("page"),
            page.alias("page_type"),
            action.alias("action"),
            F.floor(F.col("value") * 200).cast("bigint").cast("string").alias("amount"),
            seconds.cast("string").alias("ts"),
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        rows = int_ids(self.behaviour.where("action = 'order'"), ["user_id", "clue_id"])
        made = F.date_format(F.timestamp_seconds(F.col("ts").cast("bigint")),
                             "yyyy-MM-dd HH:mm:ss")
        return rows.select("user_id", "clue_id", made.alias("create_time"), "dt")

    @cached_property
    def items(self) -> DataFrame:
        key = F.col("p_partkey")

        def tag(letter, n):
            return F.concat(F.lit(letter), (key % n).cast("string"))

        words = F.split("p_name", " ")
        year = (key % 25 + 2000).cast("string")
        return self.read("part").select(
            key.cast("int").alias("clue_id"),
            tag("F", 4).alias("fuel_type"), year.alias("car_year"), tag("G", 3).alias("gearbox"),
            tag("E", 6).alias("emission_standard"), F.col("p_brand").alias("tag_id"),
            tag("C", 40).alias("city_id"), F.get(words, F.lit(0)).alias("car_color"),
            tag("N", 5).alias("guobie"), F.get(words, F.lit(1)).alias("minor_category_id"),
            F.col("p_type").alias("auto_type"), F.col("p_size").alias("seats"),
            (F.col("p_size") * 1000 + key % 1000).cast("int").alias("road_haul"),
            F.when(F.col("p_size") != 13, F.col("p_size") * 2).alias("evaluate_score"),
            F.floor("p_retailprice").cast("int").alias("suggest_price"),
            (key % 4).cast("int").alias("transfer_num"),
            (key % 20 + 2000).cast("int").alias("license_year"),
            (key % 12 + 1).cast("int").alias("license_month"),
            tag("L", 7).alias("air_displacement"),
            F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), (key % 5 + 1).cast("int"))
            .alias("evaluate_level"),
            F.concat(year, F.lit("款 "), F.col("p_name")).alias("title"),
            (key % 3).cast("int").alias("sale_status"), (key % 4).cast("int").alias("auction_type"),
            F.date_format(F.date_add(F.lit("2023-11-01").cast("date"), (key % 80).cast("int")),
                          "yyyy-MM-dd").alias("create_time"),
        )

    @cached_property
    def price_log(self) -> DataFrame:
        shifted = F.date_add(F.col("l_shipdate").cast("date"), 8110)

        def whole(c):
            return F.floor(c).cast("bigint").cast("string")

        price = F.col("l_extendedprice")
        return self.read("lineitem").select(
            F.col("l_partkey").cast("string").alias("clue_id"),
            (F.datediff(shifted, F.lit("1970-01-01").cast("date")) * 86400).alias("ts"),
            whole(price).alias("model_price"),
            whole(price * (1 - F.col("l_discount"))).alias("seller_price"),
            F.col("l_linenumber").cast("string").alias("car_level"),
            F.date_format(shifted, "yyyy-MM-dd").alias("dt"),
            F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"),
            F.col("l_extendedprice").alias("x"),
        )

    def prices(self, day: str) -> DataFrame:
        return self.stored(f"prices_{day}", lambda: item_plans.latest_prices(
            self.price_log, day, ties=PRICE_TIES))

    def priced(self, day: str) -> DataFrame:
        return item_plans.priced_items(self.items, self.prices(day), day)

    @cached_property
    def dictionary(self) -> DataFrame:
        """All versions, with the version in ``dt``: ids from 2 in text order."""
        return self.stored("dictionary", self._dictionary)

    def _dictionary(self) -> DataFrame:
        base = self.priced(RUN)
        entries = F.explode(F.array(*[
            F.struct(F.lit(d).alias("fea_name"), F.col(a).cast("string").alias("fea_val"))
            for d, a in DICTIONARY_ATTRIBUTES.items()
        ]))
        parts = None
        for version, seed in VERSIONS.items():
            rows = base.select(entries.alias("e")).select("e.*").where("fea_val is not null").distinct()
            rows = rows.where(hash32(seed, "fea_name", "fea_val") % 16 != 0).withColumn("dt", F.lit(version))
            parts = rows if parts is None else parts.unionByName(rows)
        w = Window.partitionBy("dt", "fea_name").orderBy("fea_val")
        return parts.withColumn("encode_id", (F.row_number().over(w) + 1).cast("int"))

    @cached_property
    def codes(self) -> DataFrame:
        return scan_dictionary(self.dictionary, N.DICTIONARY_VERSION)

    # -- tables other jobs would have filled ------------------------------------------

    # (each is a function of a table that has a row for every day it was asked for)

    def by_day(self, name: str, day: str, build) -> DataFrame:
        """One day of a derived table, without its day."""
        return self.stored(f"{name}_{day}", lambda: build(self.counts_between(day, day)).drop("dt"))

    def counts_between(self, start: str, end: str) -> DataFrame:
        return self.stored(f"counts_{start}_{end}", lambda: self._counts(start, end))

    @cached_property
    def log_tasks(self) -> int:
        return max(1, -(-self.behaviour.count() // ROWS_A_TASK))

    def _counts(self, start: str, end: str) -> DataFrame:
        """Rows per (dt, user, action, item) and window of days up to ``dt``, for each of the days.

        A row becomes one per later day inside a task that has all rows of its key: only
        the rows of the log are shuffled, not those of the days.
        """
        rows = int_ids(self.behaviour.where(F.col("dt") <= end), ["user_id", "clue_id"])
        rows = rows.groupBy("user_id", "action", "clue_id", F.col("dt").cast("date").alias("at")).agg(
            F.count("*").alias("n"))
        rows = rows.repartition(self.log_tasks, "user_id", "action", "clue_id")
        days = F.sequence(F.greatest("at", F.lit(start).cast("date")), F.lit(end).cast("date"))
        rows = rows.withColumn("day", F.explode(days))
        age = F.datediff("day", "at")
        return rows.groupBy(F.col("day").cast("string").alias("dt"), "user_id", "action", "clue_id").agg(*[
            F.sum(F.when(age.between(lo, hi), F.col("n")).otherwise(0)).alias(f"cnt_{w}")
            for w, (lo, hi) in WINDOWS.items()
        ])

    def action_cnt(self, day: str) -> DataFrame:
        return self.by_day("action_cnt", day, self._action_cnt)

    def _action_cnt(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action <> 'order'")
        return rows.groupBy("dt", "user_id", "action").agg(*[
            F.sum(f"cnt_{w}").alias(f"cnt_{w}") for w in ("0_7", "7_14", "14_30")])

    def convert_cnt(self, day: str) -> DataFrame:
        return self.by_day("convert_cnt", day, self._convert_cnt)

    def _convert_cnt(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action = 'order'")
        return rows.groupBy("dt", "user_id").agg(*[
            F.sum(f"cnt_{w}").alias(f"cnt_{w}") for w in ("0_30", "0_365")])

    def _by_user(self, rows: DataFrame) -> DataFrame:
        """The rows of a user and day in one task: all that is grouped by them stays there."""
        return rows.repartition(self.log_tasks, "dt", "user_id")

    def _statis(self, rows: DataFrame, windows: dict, by) -> DataFrame:
        dims = self.items.select("clue_id", *N.REFRESH_MEASURES)
        rows = self._by_user(lookup_join(rows, dims, "clue_id", "inner"))
        each = F.explode(F.array(*[
            F.struct(F.lit(d).alias("cnt_days"), F.col(f"cnt_{w}").alias("c"))
            for d, w in windows.items()
        ]))
        rows = rows.select(*by, *N.REFRESH_MEASURES, each.alias("w"))
        rows = rows.where("w.c > 0").withColumns(
            {"cnt_days": F.col("w.cnt_days"), "c": F.col("w.c")})
        aggs = []
        for m in N.REFRESH_MEASURES:
            aggs += [F.max(m).alias(f"{m}_max"), F.min(m).alias(f"{m}_min"),
                     F.round(F.percentile(m, 0.5, F.col("c")), 6).alias(f"{m}_p50")]
        return rows.groupBy(*by, "cnt_days").agg(*aggs)

    def action_statis(self, day: str) -> DataFrame:
        return self.by_day("action_statis", day, self._action_statis)

    def _action_statis(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action in ('click', 'bid')")
        return self._statis(rows, {7: "0_7", 30: "0_30"}, ["dt", "user_id", "action"])

    def convert_statis(self, day: str) -> DataFrame:
        return self.by_day("convert_statis", day, self._convert_statis)

    def _convert_statis(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action = 'order'").withColumn("convert", F.lit("beseen"))
        return self._statis(rows, {30: "0_30", 365: "0_365"}, ["dt", "user_id", "convert"])

    def _ratios(self, rows: DataFrame, windows, clusters, by) -> DataFrame:
        asked = rows.select("dt", "clue_id").where("clue_id is not null").distinct()
        prices = item_plans.prices_by_day(asked, self.price_log, ties=PRICE_TIES)
        dims = item_plans.priced_items(asked.join(self.items, "clue_id"), prices, F.col("dt"), item_plans.BY_DAY)
        rows = lookup_join(rows, dims.select("dt", "clue_id", *clusters), ["dt", "clue_id"], "inner")
        rows = self._by_user(rows)
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("cluster"), F.col(c).cast("string").alias("key"))
            for c in clusters
        ]))
        rows = rows.select(*by, *[f"cnt_{w}" for w in windows], pairs.alias("p")).select(
            *by, "p.cluster", "p.key", *[f"cnt_{w}" for w in windows]).where("key is not null")
        keyed = rows.groupBy(*by, "cluster", "key").agg(
            *[F.sum(f"cnt_{w}").alias(f"c_{w}") for w in windows])
        whole = Window.partitionBy(*by, "cluster")
        keyed = keyed.withColumns({f"t_{w}": F.sum(f"c_{w}").over(whole) for w in windows})
        return keyed.select(*by, "cluster", "key", *[
            ratio(f"c_{w}", f"t_{w}").alias(f"ratio_{w}") for w in windows])

    def action_ratio(self, day: str) -> DataFrame:
        return self.by_day("action_ratio", day, self._action_ratio)

    def _action_ratio(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action in ('click', 'bid')")
        return self._ratios(rows, ("0_7", "7_14", "14_30"), N.CLUSTERS, ["dt", "user_id", "action"])

    def convert_ratio(self, day: str) -> DataFrame:
        return self.by_day("convert_ratio", day, self._convert_ratio)

    def _convert_ratio(self, counts: DataFrame) -> DataFrame:
        rows = counts.where("action = 'order'")
        return self._ratios(rows, ("0_30", "0_365"), N.ORDER_CLUSTERS, ["dt", "user_id"])

    def rates(self, day: str) -> tuple:
        return tuple(f.drop("dt") for f in self.rates_between(day, day))

    def rates_between(self, start: str, end: str) -> tuple:
        built = []

        def part(i):
            if not built:
                built.extend(self._rates(self.counts_between(start, end)))
            return built[i]

        return tuple(
            self.stored(f"rates_{i}_{start}_{end}", lambda i=i: part(i)) for i in range(3))

    def _rates(self, counts: DataFrame) -> tuple:
        """(item rates, tag shares of bids, tag and category rates), one row per item and day."""
        per = counts.groupBy("dt", "clue_id").agg(*[
            F.sum(F.when(F.col("action") == a, F.col(f"cnt_{w}")).otherwise(0)).alias(f"{a}_{w}")
            for a in ("beseen", "click", "bid") for w in WINDOWS
        ])
        item_rate = per.select("dt", "clue_id", *[
            ratio(f"{n}_{w}", f"{d}_{w}").alias(f"{d}_{n}_rate_{w}")
            for d, n in (("click", "bid"), ("beseen", "click")) for w in ("0_3", "0_30")
        ])
        dims = self.items.select("clue_id", "tag_id", "minor_category_id")
        both = dims.join(per, "clue_id")
        sums = [c for c in per.columns if c not in ("dt", "clue_id")]

        def grouped(*key):
            return both.groupBy("dt", *key).agg(*[F.sum(c).alias(c) for c in sums])

        totals = grouped().select("dt", *[F.col(f"bid_{w}").alias(f"all_{w}") for w in ("0_7", "7_14", "14_30")])
        tags = grouped("tag_id").join(totals, "dt")
        shares = dims.join(tags, "tag_id").select("dt", "clue_id", *[
            ratio(f"bid_{w}", f"all_{w}").alias(f"tag_id_bid_percent_ratio_{w}")
            for w in ("0_7", "7_14", "14_30")])
        tag_rates = dims.join(tags, "tag_id").select("dt", "clue_id", *[
            ratio(f"{n}_{w}", f"{d}_{w}").alias(f"tag_id_{n}_rate_{w}")
            for d, n in (("beseen", "click"), ("click", "bid")) for w in ("0_7", "7_14")])
        category = dims.join(grouped("minor_category_id"), "minor_category_id").select(
            "dt", "clue_id", ratio("click_0_7", "beseen_0_7").alias("minor_category_id_click_rate_0_7"))
        return item_rate, shares, tag_rates.join(category, ["dt", "clue_id"], "left")

    def users(self, day: str) -> DataFrame:
        return self.stored(f"users_{day}", lambda: self.user_features(day))

    def user_features(self, day: str) -> DataFrame:
        return user_plans.user_offline_features(
            self.action_cnt(day), self.convert_cnt(day), self.action_statis(day),
            self.convert_statis(day), self.action_ratio(day), self.convert_ratio(day), self.codes)

    def users_between(self, start: str, end: str) -> DataFrame:
        """The user features of every day from ``start`` to ``end``, in one job.

        Its inputs are not written in between: each comes by user and day already, and
        its categories, 14 rows for a row of counts, are never shuffled.
        """
        def build():
            counts = self.counts_between(start, end)
            return user_plans.user_offline_features(
                self._by_user(self._action_cnt(counts)), self._by_user(self._convert_cnt(counts)),
                self._action_statis(counts), self._convert_statis(counts),
                self._action_ratio(counts), self._convert_ratio(counts), self.codes,
                key=("dt", "user_id"), placed=True)

        return self.stored(f"users_{start}_{end}", build)

    def items_between(self, start: str, end: str) -> DataFrame:
        days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
        return self.items.withColumn("dt", F.explode(F.transform(days, lambda d: d.cast("string"))))

    def refresh_users(self, day: str) -> DataFrame:
        return self.stored(f"refresh_users_{day}", lambda: user_plans.refresh_user_features(
            self.action_cnt(day), self.convert_cnt(day), self.action_statis(day),
            self.action_ratio(day), self.convert_ratio(day), self.codes))

    # -- results further queries start from ----------------------------------------------

    @cached_property
    def inputs(self) -> Inputs:
        return Inputs(
            behaviour=self.behaviour, orders=self.orders, price_log=self.price_log,
            dictionary=self.codes, items=lambda day: self.items, rates=self.rates,
            users=self.users, min_create=MIN_CREATE, price_ties=PRICE_TIES,
            days_of={"items": self.items_between, "rates": self.rates_between, "users": self.users_between})

    @cached_property
    def log_days(self) -> tuple[str, str]:
        """The first and the last day of the log."""
        return tuple(self.behaviour.agg(F.min("dt"), F.max("dt")).first())

    @cached_property
    def samples(self) -> DataFrame:
        return self.stored("samples", lambda: train_samples(self.behaviour))

    @cached_property
    def day_prices(self) -> DataFrame:
        """The latest price as of each day on which an item was labelled."""
        asked = label_events(self.behaviour).where("clue_id is not null").select("dt", "clue_id").distinct()
        return self.stored("day_prices", lambda: item_plans.prices_by_day(
            asked, self.price_log, ties=PRICE_TIES))

    def label_impressions(self) -> DataFrame:
        return impression_labels(self.behaviour, self.day_prices, self.orders)

    @cached_property
    def impressions(self) -> DataFrame:
        return self.stored("impressions", self.label_impressions)

    @cached_property
    def clicks(self) -> DataFrame:
        rows = self.behaviour.where("action = 'click'")
        return int_ids(rows, ["user_id", "clue_id", "ts"]).select("user_id", "clue_id", "ts")

    @cached_property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select("vec_id", "embedding", "label")

    @cached_property
    def old_vectors(self) -> DataFrame:
        """The last run: label 9 was not there yet; labels below 3 have moved."""
        first = F.get("embedding", F.lit(0)).cast("double")
        moved = first + F.when(F.col("label") < 3, 0.5).otherwise(1e-9)
        rest = F.expr("cast(slice(embedding, 2, size(embedding)) as array<double>)")
        return self.vectors.where("label <> 9").select(
            "vec_id", F.concat(F.array(moved), rest).alias("embedding"))

    @cached_property
    def scored(self) -> DataFrame:
        return self.stored("scored", self._scored)

    def _scored(self) -> DataFrame:
        """Impressions with a score of two digits, so that scores tie."""
        from paddock.operators.evaluate import score_pairs

        users = self.vectors.select(F.col("vec_id").cast("int").alias("user_id"),
                                    F.col("embedding").alias("user_embedding"))
        items = self.vectors.select(F.col("vec_id").cast("int").alias("clue_id"),
                                    F.col("embedding").alias("item_embedding"))
        pairs = self.impressions.select(
            "dt", "user_id", "clue_id", "recommend_id", F.col("is_bid").alias("label"), "ts")
        return score_pairs(users, items, pairs).withColumn("score", F.round("score", 2))

    @cached_property
    def features(self) -> DataFrame:
        return self.stored("features", self._features)

    def _features(self) -> DataFrame:
        """A feature table as the daily job leaves it, over all impressions."""
        from paddock.operators.sequences import last_items

        item = item_plans.item_table(
            self.items, self.prices(RUN), self.rates(SNAP), self.codes, RUN
        ).select("clue_id", "s_i_tag_id", "s_i_city_id", "d_i_c2b_evaluate_score",
                 "d_i_c2b_ctob_model_price", "d_i_road_haul")
        user = self.users(SNAP).select(
            "user_id", "s_u_click_tag_id_0_7", "d_u_click_cnt_0_7",
            "d_u_click_road_haul_max_0_7")
        seqs = last_items(
            self.impressions, self.clicks, self.sequence_items,
            ["clue_id", "tag_id", "road_haul", "seller_price"]
        ).withColumnRenamed("clue_id", "clues")
        rows = self.impressions.select(
            "user_id", "clue_id", "recommend_id", F.col("is_bid").alias("label"), "ts", "dt")
        rows = lookup_join(rows, item, "clue_id")
        rows = lookup_join(rows, user, "user_id")
        rows = lookup_join(rows, seqs, ["user_id", "ts"])
        return rows.select(
            "user_id", "clue_id", "recommend_id", "label", "ts",
            "s_u_click_tag_id_0_7", "d_u_click_cnt_0_7", "d_u_click_road_haul_max_0_7",
            "s_i_tag_id", "s_i_city_id", "d_i_c2b_evaluate_score", "d_i_c2b_ctob_model_price",
            "d_i_road_haul",
            F.concat_ws(",", pad_array("clues", 10, "1")).alias("s_seq_c2b_click_clue_id_seq"),
            F.concat_ws(",", pad_array("tag_id", 10, "1")).alias("s_seq_c2b_click_tag_id_seq"),
            F.concat_ws(",", F.col("road_haul").cast("array<string>")).alias(
                "d_seq_c2b_click_road_haul_seq"),
            F.concat_ws(",", F.col("seller_price").cast("array<string>")).alias(
                "d_seq_c2b_click_c2b_seller_price_seq"),
            "dt",
        )

    @cached_property
    def sequence_items(self) -> DataFrame:
        from paddock.plans.histories import sequence_attributes

        return self.stored("sequence_items", lambda: sequence_attributes(
            self.priced(RUN), self.codes))
