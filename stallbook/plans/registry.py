"""Every operator as a query over the star-schema tables, by name."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook import schemas
from stallbook.functions import dates
from stallbook.functions.vectors import stored_precision
from stallbook.operators import (analytics, embedding, knn, matching, ordered, pivots, profiling, quality, search,
                                 sketches)
from stallbook.plans import embed_reviews, profile, retail, star
from stallbook.sources import catalog, csv_files, tables
from stallbook.sources.keyed import KeyedTable
from stallbook.sources.shared import new_folder, pinned

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Column types another engine prints alike: whole numbers as bigint,
    decimals as double, dates and times as text."""
    def same(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[same(f) for f in df.schema.fields])


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(function(spark, folder))

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- analytics ----------------------------------------------------------------

@_query
def late_deliveries(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.late_deliveries(t["arrived_orders"], t["customers"], t["order_items"], t["products"])


def _childless_orders(spark, folder, method):
    t = star.typed_tables(spark, folder)
    return matching.unmatched(t["orders"].select("order_id"), t["order_items"], "order_id", method=method)


@_query
def unmatched_not_exists(spark, folder):
    return _childless_orders(spark, folder, "not_exists")


@_query
def unmatched_not_in(spark, folder):
    return _childless_orders(spark, folder, "not_in")


@_query
def unmatched_left_null(spark, folder):
    return _childless_orders(spark, folder, "left_null")


@_query
def unlabelled_documents(spark, folder):
    given = tables.read_tables(spark, folder, ["documents", "labels"])
    return matching.unmatched(given["documents"].select("doc_id", "lang"), given["labels"], "doc_id")


@_query
def never_ordered_products(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.never_ordered(t["products"], t["order_items"])


@_query
def monthly_revenue(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.monthly_revenue(t["orders"], t["payments"], star.EXCLUDED)


@_query
def category_scores(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.category_scores(t["order_items"], t["products"], t["order_reviews"])


@_query
def seller_ranks(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.seller_ranks(t["sellers"], t["order_items"])


@_query
def running_spend(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.running_spend(t["orders"], t["customers"], t["payments"])


@_query
def top_products(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.top_products(t["order_items"], t["products"])


@_query
def churned_customers(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.churned(t["orders"], t["customers"])


@_query
def churned_by_antijoin(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.churned_by_antijoin(t["orders"], t["customers"])


@_query
def top_categories(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.top_categories(t["order_items"], t["orders"], t["products"], exclude_status=star.EXCLUDED)


@_query
def monthly_top_category(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.monthly_top_category(t["order_items"], t["orders"], t["products"], star.EXCLUDED)


@_query
def cut_line_band(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.cut_line_band(t["order_items"], t["orders"], t["sellers"], exclude_status=star.EXCLUDED)


@_query
def repeat_share(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.repeat_share(t["orders"], t["customers"], t["payments"], star.EXCLUDED)


@_query
def delay_vs_score(spark, folder):
    t = star.typed_tables(spark, folder)
    return analytics.delay_vs_score(t["arrived_orders"], t["order_reviews"], delivered=star.DELIVERED)


@_query
def shipment_delay_vs_score(spark, folder):
    """Each day an order ships on as a delivery, which fills all five timings.

    The lines of a day are one delivery, so an order with most of the lines
    brings no more rows than there are days.
    """
    t = star.typed_tables(spark, folder)
    shipped = t["order_items"].select(
        "order_id", F.col("shipping_limit_date").alias("order_delivered_customer_date")).distinct()
    return analytics.delay_vs_score(shipped.join(t["orders"], "order_id"), t["order_reviews"],
                                    delivered=star.DELIVERED)


# --- vectors and embedding ------------------------------------------------------

def _vectors(spark, folder):
    return tables.read_tables(spark, folder, ["embeddings"])["embeddings"]


def _nearest(spark, folder, metric):
    found = search.nearest(_vectors(spark, folder), seed=0, metric=metric, key="vec_id")
    return found.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@_query
def nearest_cosine(spark, folder):
    return _nearest(spark, folder, "cosine")


@_query
def nearest_l2(spark, folder):
    return _nearest(spark, folder, "l2")


@_query
def nearest_inner_product(spark, folder):
    return _nearest(spark, folder, "inner_product")


def _nearest_indexed(spark, folder, metric):
    """By stored distances to pivots, which leave out what cannot be near."""
    index = pivots.PivotIndex.build(_vectors(spark, folder), new_folder(spark, "pivots"), key="vec_id")
    found = index.nearest(seed=0, metric=metric, key="vec_id")
    return found.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@_query
def nearest_cosine_indexed(spark, folder):
    return _nearest_indexed(spark, folder, "cosine")


@_query
def nearest_l2_indexed(spark, folder):
    return _nearest_indexed(spark, folder, "l2")


@_query
def nearest_inner_product_indexed(spark, folder):
    return _nearest_indexed(spark, folder, "inner_product")


def _nearest_to_each(spark, folder, metric):
    """The nearest rows of every vector with an id divisible by 50."""
    table = _vectors(spark, folder)
    found = knn.nearest_to_each(table, table.where("vec_id % 50 = 0"), metric=metric, key="vec_id")
    return found.select("seed", "vec_id", F.round("distance", 6).alias("distance"), "position")


@_query
def nearest_to_each_cosine(spark, folder):
    return _nearest_to_each(spark, folder, "cosine")


@_query
def nearest_to_each_l2(spark, folder):
    return _nearest_to_each(spark, folder, "l2")


@_query
def nearest_to_each_inner_product(spark, folder):
    return _nearest_to_each(spark, folder, "inner_product")


def _documents(spark, folder):
    return tables.read_tables(spark, folder, ["documents"])["documents"]


def _document_vectors(spark, folder):
    return _vectors(spark, folder).select(F.col("vec_id").alias("doc_id"), "embedding")


def _pending(spark, folder, limit):
    return embedding.pending(_documents(spark, folder), _document_vectors(spark, folder),
                             key="doc_id", text="text", limit=limit)


@_query
def pending_texts(spark, folder):
    return _pending(spark, folder, embedding.SAMPLE_SIZE)


@_query
def embedded_texts(spark, folder):
    vectors = embedding.embed(_pending(spark, folder, None), embedding.hashed_tokens(), key="doc_id", text="text")
    return vectors.select("doc_id", F.size("embedding").alias("dimensions"))


@_query
def embedded_vectors(spark, folder):
    """The vectors themselves, by component, of the texts that have none yet."""
    vectors = embedding.embed(_pending(spark, folder, None), embedding.hashed_tokens(), key="doc_id", text="text")
    return _components(vectors).where("component <> 0")


def _components(df):
    return df.select("doc_id", F.posexplode("embedding").alias("position", "component")).select(
        "doc_id", "position", F.round(F.col("component").cast("double"), 6).alias("component"))


def _fresh_vectors(spark, folder):
    """New vectors for the labelled documents, made from the old ones."""
    labels = tables.read_tables(spark, folder, ["labels"])["labels"]
    return (matching.with_partner(_document_vectors(spark, folder), labels, "doc_id")
            .select("doc_id", stored_precision(F.transform("embedding", lambda x: x / 2)).alias("embedding")))


@_query
def vectors_updated(spark, folder):
    return _components(embedding.update_by_key(_document_vectors(spark, folder), _fresh_vectors(spark, folder),
                                               "doc_id", "embedding"))


@_query
def vectors_upserted(spark, folder):
    shifted = _fresh_vectors(spark, folder).withColumn("doc_id", F.col("doc_id") * 2)
    return _components(embedding.upsert_vectors(_document_vectors(spark, folder), shifted, "doc_id"))


@_query
def vectors_written_back(spark, folder):
    """New vectors merged into a written table, in which only their keys' buckets are rewritten, and read back."""
    path = new_folder(spark, "vectors")
    embed_reviews.write_back(_document_vectors(spark, folder), path, "doc_id")
    shifted = _fresh_vectors(spark, folder).withColumn("doc_id", F.col("doc_id") * 2)
    embed_reviews.write_back(shifted, path)
    return _components(embed_reviews.read_vectors(spark, path))


@_query
def vectors_replaced(spark, folder):
    """The same for keys that are there already: no row is added."""
    path = new_folder(spark, "vectors")
    table = KeyedTable.create(_document_vectors(spark, folder), path, "doc_id", embed_reviews.BUCKETS)
    table.merge(_fresh_vectors(spark, folder).withColumn("doc_id", F.col("doc_id") * 2), insert=False)
    return _components(table.read())


@_query
def embedded_count(spark, folder):
    read = embedding.with_embedding(_documents(spark, folder).select("doc_id"),
                                    _document_vectors(spark, folder), "doc_id")
    return embedding.embedded_count(read)


# --- cleaning ---------------------------------------------------------------------

def _clean(spark, folder, table):
    return retail.clean(star.landed_tables(spark, folder))[table]


@_query
def dropped_orders(spark, folder):
    return retail.unusable_orders(star.landed_tables(spark, folder)["orders"])


@_query
def clean_customers(spark, folder):
    return _clean(spark, folder, "customers")


@_query
def clean_geolocation(spark, folder):
    return _clean(spark, folder, "geolocation")


@_query
def clean_sellers(spark, folder):
    return _clean(spark, folder, "sellers")


@_query
def clean_translation(spark, folder):
    used = _clean(spark, folder, "products").select("product_category_name").distinct()
    return used.join(_clean(spark, folder, "product_category_translation"), "product_category_name", "left")


@_query
def clean_products(spark, folder):
    return _clean(spark, folder, "products")


@_query
def clean_orders(spark, folder):
    return _clean(spark, folder, "orders")


@_query
def clean_order_items(spark, folder):
    return _clean(spark, folder, "order_items")


@_query
def clean_payments(spark, folder):
    return _clean(spark, folder, "payments")


@_query
def clean_order_reviews(spark, folder):
    return _clean(spark, folder, "order_reviews").drop("embedding")


@_query
def latest_line_per_order(spark, folder):
    line = tables.read_tables(spark, folder, ["lineitem"])["lineitem"]
    return ordered.latest_per_key(line, ["l_orderkey"], "l_shipdate")


# --- quality ----------------------------------------------------------------------

def _expected(spark, folder):
    rows = star.landed_rows(spark, folder)
    return retail.Expectations(
        landed_rows=rows,
        typed_rows={**{t: rows[t] for t in ("customers", "geolocation", "sellers", "products", "orders",
                                            "order_items", "order_reviews")},
                    "payments": rows["order_payments"],
                    "product_category_translation": rows["product_category_name_translation"]},
        imputed_orders=0, undelivered_orders=0, fallback_products=0, delivered_before_handover=0)


def _landed(spark, folder):
    """The landed tables. The orders are derived from the lines and read many
    times by the jobs below, so they are written down first."""
    derived = star.landed_tables(spark, folder)
    orders = pinned(derived["orders"])
    return ChainMap(tables.Tables({"orders": lambda: orders}), derived)


def _report(spark, folder, checks):
    landed = _landed(spark, folder)
    dropped = retail.dropped_orders(landed)
    return retail.typed_report(retail.clean(landed, dropped), landed, checks, dropped)


@_query
def landed_row_counts(spark, folder):
    return quality.run_checks(star.landed_tables(spark, folder),
                              retail.landing_checks(_expected(spark, folder)))


@_query
def typed_row_counts(spark, folder):
    return _report(spark, folder, quality.row_counts(_expected(spark, folder).typed_rows))


@_query
def unique_key_report(spark, folder):
    return _report(spark, folder, quality.unique_keys())


@_query
def reference_report(spark, folder):
    return _report(spark, folder, quality.references())


def _dropped_references(spark, folder, compact):
    landed = _landed(spark, folder)
    typed = retail.clean(landed)
    children = ["order_items", "order_payments", "order_reviews", "customers"]
    found = {f"landed_{name}": landed[name] for name in children}
    return quality.run_checks({**found, "orders": typed["orders"]}, [
        quality.Reference(name, "customer_id" if name == "landed_customers" else "order_id", "orders", compact=compact)
        for name in found])


@_query
def dropped_reference_report(spark, folder):
    """References from the landed rows to the cleaned orders: what the drop would have orphaned."""
    return _dropped_references(spark, folder, compact=False)


@_query
def dropped_references_by_bitmap(spark, folder):
    """The same by comparing bitmaps of the keys."""
    return _dropped_references(spark, folder, compact=True)


@_query
def row_rule_report(spark, folder):
    return _report(spark, folder, quality.row_rules())


@_query
def reported_rule_counts(spark, folder):
    return _report(spark, folder, quality.reported_rules(box=(0, 0.05, 0, 0.04)))


@_query
def not_null_report(spark, folder):
    return _report(spark, folder, quality.not_nulls())


@_query
def cleaning_report(spark, folder):
    return _report(spark, folder, retail.cleaning_checks(_expected(spark, folder)))


@_query
def failed_checks(spark, folder):
    report = _report(spark, folder, [*quality.unique_keys(), *quality.row_rules()])
    return quality.failures(report)


def _published(spark, folder, checks):
    """The whole job: gate, clean, write, gate, publish."""
    root = new_folder(spark, "published")
    retail.build(_landed(spark, folder), root, _expected(spark, folder), checks)
    return root


@_query
def published_row_counts(spark, folder):
    """What the write of the published tables counted."""
    checks = [*quality.not_nulls(), *quality.references(),
              quality.HasChild("customers", "customer_id", "orders"), quality.NoColumnLike("lenght")]
    typed = tables.read_published(spark, _published(spark, folder, checks), retail.TABLES)
    return spark.createDataFrame([(name, typed.metrics[name]["rows"]) for name in typed], "subject string, actual long")


@_query
def published_checks(spark, folder):
    """Rules and NOT NULLs of the published tables, as their write observed them; nothing is read again."""
    checks = [*quality.not_nulls(), *quality.row_rules(), *quality.reported_rules(box=(0, 0.05, 0, 0.04))]
    root = _published(spark, folder, checks)
    return retail.published_report(spark, root, checks)


def _violations(spark, folder, checks):
    landed = _landed(spark, folder)
    return quality.run_checks(star.planted(retail.clean(landed)), checks)


@_query
def violated_rules(spark, folder):
    return _violations(spark, folder, quality.row_rules())


@_query
def violated_not_nulls(spark, folder):
    return _violations(spark, folder, quality.not_nulls())


@_query
def violated_references(spark, folder):
    return _violations(spark, folder, quality.references())


@_query
def products_without_small_orders(spark, folder):
    """Products no one ever ordered three or fewer of."""
    t = star.typed_tables(spark, folder)
    small = tables.read_tables(spark, folder, ["lineitem"])["lineitem"].where("l_quantity <= 3")
    return analytics.never_ordered(t["products"], small.select(F.col("l_partkey").alias("product_id")))


@_query
def versions_with_added_column(spark, folder):
    """Reviews published without the vector column, then with it: the first version's are NULL."""
    root = new_folder(spark, "versions")
    reviews = _clean(spark, folder, "order_reviews")
    vector = F.when(F.col("review_score") == 4, F.array(F.col("review_score").cast("float"), F.lit(0.5).cast("float")))
    for df in (reviews.drop("embedding"), reviews.withColumn("embedding", vector)):
        tables.reload(spark, root, {"order_reviews": df}, lambda written: None)
    schema = schemas.typed_schema("order_reviews")
    found = tables.read_versions(spark, root, "order_reviews", schema)
    return found.select("version", "order_id", F.get("embedding", F.lit(0)).alias("first_component"),
                        F.lit(found.schema["embedding"].metadata["comment"]).alias("comment"))


@_query
def catalog_columns_like(spark, folder):
    """Of the tables registered in the catalog, the columns LIKE 'l!_%key' with '!' as the escape."""
    database = f"stallbook_{uuid4().hex}"
    given = {name: f"{folder}/{name}.parquet" for name in star.STAR_TABLES}
    catalog.register(spark, database, given, new_folder(spark, "catalog"))
    try:
        found = catalog.columns_like(spark, database, "l!_%key", "!")
        return found.unionByName(catalog.columns_like(spark, database, "_ag_")).unionByName(
            catalog.columns_like(spark, database, "%nation_ey%")).select("table", "column")
    finally:
        catalog.unregister(spark, database)


@_query
def published_orphan_products(spark, folder):
    """Products that cleaning left without an order."""
    typed = retail.clean(star.landed_tables(spark, folder))
    return analytics.never_ordered(typed["products"], typed["order_items"])


# --- profiling --------------------------------------------------------------------

def _profile(spark, folder, report):
    return profile.profile(star.landed_tables(spark, folder))[report]


@_query
def key_uniqueness(spark, folder):
    return _profile(spark, folder, "key_uniqueness")


def _batches(spark, folder, makers, metrics):
    """What the writes of three batches observed: the rows of each table as they might arrive."""
    root = new_folder(spark, "batches")
    found = []
    for batch in range(3):
        part = {name: df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == batch) for name, df in makers.items()}
        version, values = tables.write_version(part, root, metrics)
        tables.publish(spark, root, version, metrics=values)
        found.append(values)
    return found


@_query
def key_uniqueness_by_sketches(spark, folder):
    """Distinct counts merged from three batches' sketches, held against the exact ones."""
    landed = star.landed_tables(spark, folder)
    makers = {table: landed[table] for table, _ in profile.CANDIDATE_KEYS}
    writes = _batches(spark, folder, makers, sketches.distinct_metrics(profile.CANDIDATE_KEYS))
    found = sketches.distinct_counts(spark, writes, profile.CANDIDATE_KEYS)
    exact = _profile(spark, folder, "key_uniqueness").drop("rows")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_vals")) <= sketches.distinct_error() * F.col("distinct_vals")
    return found.join(exact, "candidate_key").select("candidate_key", "rows", "distinct_vals", near.alias("estimate_is_near"))


@_query
def cast_validity(spark, folder):
    """Every typed column of the landed tables, and two columns of another kind:
    numbers inside JSON, all valid, and names, none valid."""
    given = tables.read_tables(spark, folder, ["events", "part"])
    others = {"events": given["events"].select(F.get_json_object("props", "$.k").alias("k")),
              "part": given["part"].select("p_name")}
    return profiling.cast_validity(ChainMap(others, star.landed_tables(spark, folder)),
                                   [*profile.casts(), ("events", "k", "int"), ("part", "p_name", "int")])


@_query
def missing_dates_by_status(spark, folder):
    return _profile(spark, folder, "missing_dates_by_status")


@_query
def reviews_per_order(spark, folder):
    return _profile(spark, folder, "reviews_per_order")


@_query
def rows_per_review_id(spark, folder):
    return _profile(spark, folder, "rows_per_review_id")


@_query
def orphan_report(spark, folder):
    zips = ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix")
    return profiling.orphan_report(star.landed_tables(spark, folder), [*profile.RELATIONS, zips])


@_query
def missing_translations(spark, folder):
    return _profile(spark, folder, "missing_translations")


@_query
def coverage_gaps(spark, folder):
    return _profile(spark, folder, "coverage_gaps")


@_query
def encoding_sample(spark, folder):
    return profiling.encoding_sample(_documents(spark, folder), "text")


@_query
def byte_order_marks(spark, folder):
    return profiling.byte_order_marks(_documents(spark, folder), ["text", "lang", "source"])


@_query
def planted_byte_order_marks(spark, folder):
    """With marks put before some of the texts and languages."""
    marked = _documents(spark, folder)
    for column, each in (("text", 10), ("lang", 7)):
        marked = marked.withColumn(column, F.when(F.col("doc_id") % each == 0, F.concat(F.lit("\ufeff"), column))
                                   .otherwise(F.col(column)))
    return profiling.byte_order_marks(marked, ["text", "lang", "source"])


@_query
def uncovered_zips(spark, folder):
    return _profile(spark, folder, "uncovered_customer_zips")


@_query
def customer_coordinates(spark, folder):
    typed = retail.clean(star.landed_tables(spark, folder))
    located = matching.with_coordinates(typed["customers"], "customer_zip_code_prefix", typed["geolocation"])
    return located.select("customer_id", F.round(F.col("geolocation_lat").cast("double"), 6).alias("lat"),
                          F.round(F.col("geolocation_lng").cast("double"), 6).alias("lng"), "points")


@_query
def handover_gaps(spark, folder):
    orders = tables.read_tables(spark, folder, ["orders", "lineitem"])
    dated = orders["lineitem"].join(orders["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    return profiling.gap_statistics(dated, "o_orderdate", "l_shipdate")


@_query
def handover_gaps_by_sketches(spark, folder):
    """The same statistics merged from three batches; the estimated median's true rank is near the middle."""
    given = tables.read_tables(spark, folder, ["orders", "lineitem"])
    dated = given["lineitem"].join(given["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderdate", "l_shipdate")
    metrics = {"dated": sketches.gap_metrics("o_orderdate", "l_shipdate")}
    writes = [values["dated"] for values in _batches(spark, folder, {"dated": dated}, metrics)]
    found = sketches.gap_statistics(spark, writes)
    days = dates.seconds_between("l_shipdate", "o_orderdate").cast("double") / 86400
    median = found.select("median_days").scalar()
    ranks = dated.agg((F.count_if(days < median - 0.0001) / F.count("*")).alias("below"),
                      (F.count_if(days <= median + 0.0001) / F.count("*")).alias("upto"))
    error = F.lit(sketches.rank_error())
    near = ranks.select((F.col("below") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)).scalar()
    return found.select("rows", "mean_days", "negative", near.alias("median_is_near"))


@_query
def conflicting_reviews(spark, folder):
    reviews = star.landed_tables(spark, folder)["order_reviews"]
    return profiling.conflicting_duplicates(reviews.withColumn("review_score", F.col("review_score").cast("int")),
                                            "order_id", "review_score")


@_query
def person_attributes(spark, folder):
    orders = tables.read_tables(spark, folder, ["orders"])["orders"]
    return profiling.attribute_multiplicity(orders, "o_custkey", ["o_orderstatus", "o_orderpriority"])


# --- sources and sinks --------------------------------------------------------------

@_query
def csv_landing(spark, folder):
    """Texts written as CSV, then landed again: line breaks, quotes and all."""
    path = new_folder(spark, "csv")
    columns = ["doc_id", "text", "lang", "source"]
    csv_files.write_csv(_documents(spark, folder).select(*columns), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return csv_files.read_csv(spark, path, schema, line_breaks=True)


@_query
def json_rows(spark, folder):
    return tables.json_rows(tables.read_tables(spark, folder, ["customer"])["customer"])


@_query
def json_array(spark, folder):
    """The nations of one region."""
    nations = tables.read_tables(spark, folder, ["nation"])["nation"]
    return tables.json_array(nations.where("n_regionkey = 1").orderBy("n_nationkey"))
