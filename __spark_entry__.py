"""

Every query reads the given tables whole. Ratios, logs and sums of irrational
products are rounded to six places on both sides, before they meet a threshold.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tasteloom.functions import cosine, score_in  # noqa: E402
from tasteloom.operators import content, factors, realtime, statistics, tags, tuning  # noqa: E402
from tasteloom.operators.approximate import approximate_index  # noqa: E402
from tasteloom.operators.ranking import as_recs, newest_per_user, recent, top_per_key  # noqa: E402
from tasteloom.operators.similarity import (  # noqa: E402
    SimilarityIndex,
    dense_index,
    document_classes,
    recs_as_map,
)
from tasteloom.plans import jobs  # noqa: E402
from tasteloom.plans.session import checkpoint_folder  # noqa: E402
from tasteloom.schemas import RATING, RATING_TABLE, SEARCH_TABLE  # noqa: E402
from tasteloom.sources import text, warehouse  # noqa: E402
from tasteloom.sources.colocated import write_colocated  # noqa: E402
from tasteloom.sources.streams import FolderSink, file_lines  # noqa: E402
from tasteloom.sources.tables import (  # noqa: E402
    Store,
    latest,
    latest_of,
    merge_batches,
    one_per_key,
    read_table,
    settled,
    upsert_batches,
    write_keyed,
    write_table,
)
from tasteloom.streaming import logs, recommend, state  # noqa: E402

# The training-data operators are an optional part; what they need themselves is not.
try:
    from tasteloom.llm import queries as llm  # noqa: E402
    from tasteloom.llm import sql as llm_sql  # noqa: E402
except ImportError as error:
    if not (error.name or "").startswith("tasteloom.llm"):
        raise
    llm = llm_sql = None

DIGITS = 6
VECTOR_THRESHOLD = 0.3
COLOCATED_BUCKETS = 8


def _rounded(name: str):
    return F.round(name, DIGITS).alias(name)


def _run_store(spark: SparkSession) -> Store:
    """A new folder for what one run of a query stores."""
    return Store(f"{checkpoint_folder(spark)}/tasteloom/{uuid.uuid4().hex}")


# --- statistics -------------------------------------------------------------------


def genres_top(spark: SparkSession, folder: str) -> DataFrame:
    top = statistics.genres_top(
        warehouse.items(spark, folder),
        warehouse.ratings(spark, folder),
        warehouse.CATALOGUE_GENRES,
    )
    return top.select("genre", "rank", "mid", _rounded("avg"))


def rate_more_items(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.rate_more(warehouse.ratings(spark, folder))


def rate_more_recently(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.rate_more_recently(warehouse.ratings(spark, folder))


def average_items(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.average(warehouse.ratings(spark, folder)).select("mid", _rounded("avg"))


def monthly_scores(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.monthly(warehouse.ratings(spark, folder))


def _statistic_by_sql(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        view = f"ratings_{uuid.uuid4().hex}"
        warehouse.ratings(spark, folder).createOrReplaceTempView(view)
        out = statistics.by_sql(spark, name, view)
        return out.withColumn("avg", _rounded("avg")) if name == "average" else out

    return run


def genre_matches(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.genre_matches(warehouse.items(spark, folder), warehouse.CATALOGUE_GENRES)


# --- text, tags and tables --------------------------------------------------------


def item_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tags.item_tags(warehouse.tags(spark, folder))


def items_with_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tags.items_with_tags(warehouse.items(spark, folder), warehouse.tags(spark, folder))


def _lines(rows: DataFrame, mark: str, *columns) -> DataFrame:
    return rows.select(F.concat_ws(mark, *columns).alias("value"))


def parsed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue rows written as padded ``^`` text and parsed again."""
    part = warehouse.table(spark, folder, "part")
    padded = F.concat(F.lit(" \t"), F.col("p_name"), F.lit("  "))
    blank = F.lit("")
    lines = _lines(
        part, "^", "p_partkey", padded, "p_brand", F.col("p_size").cast("string"),
        blank, blank, blank, F.upper("p_type"), "p_brand", blank,
    )
    return text.parse_items(lines)


def parsed_ratings(spark: SparkSession, folder: str) -> DataFrame:
    ratings = warehouse.ratings(spark, folder)
    return text.parse_ratings(_lines(ratings, ",", "uid", "mid", "score", "timestamp"))


def parsed_tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = warehouse.tags(spark, folder)
    padded = F.concat(F.lit("\t "), F.col("tag"), F.lit(" "))
    return text.parse_tags(_lines(rows, ",", "uid", "mid", padded, "timestamp"))


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines that are no rating messages, as the quarantine returns them."""
    _, bad = text.parse_rating_events(warehouse.log_lines(spark, folder))
    return bad


def stored_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings written as a table sorted by user and item, and read back."""
    store = _run_store(spark)
    write_table(warehouse.ratings(spark, folder), store, "ratings", ["uid", "mid"])
    return read_table(spark, store, "ratings", RATING)


def colocated_item_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings and items in the same buckets of the item, joined and summed without a shuffle."""
    store = _run_store(spark)
    ratings, found = warehouse.ratings(spark, folder), warehouse.items(spark, folder)
    left = write_colocated(ratings, store, "ratings_by_item", "mid", COLOCATED_BUCKETS)
    right = write_colocated(found, store, "items_by_item", "mid", COLOCATED_BUCKETS)
    sums = [F.count("score").alias("n"), F.sum("score").alias("score_sum")]
    return right.join(left.drop("uid"), "mid", "left").groupBy("mid", "name").agg(*sums)


def keyed_tags(spark: SparkSession, folder: str) -> DataFrame:
    """One document per item: its newest tag."""
    order = [F.desc("timestamp"), F.asc("uid"), F.asc("tag")]
    return one_per_key(warehouse.tags(spark, folder), "mid", order)


# --- content similarity -----------------------------------------------------------


def content_term_weights(spark: SparkSession, folder: str) -> DataFrame:
    return content.tfidf(warehouse.items(spark, folder)).select(
        "mid", "term", "tf", _rounded("idf"), _rounded("weight")
    )


def content_idf(spark: SparkSession, folder: str) -> DataFrame:
    return content.idf(warehouse.items(spark, folder)).select("term", "df", _rounded("idf"))


def _content_index(
    spark: SparkSession, folder: str, store: Store | None = None
) -> SimilarityIndex:
    items = warehouse.items(spark, folder)
    return content.similar(items, digits=DIGITS, store=store or _run_store(spark))


def content_classes(spark: SparkSession, folder: str) -> DataFrame:
    docs = content.documents(warehouse.items(spark, folder))
    return docs.join(document_classes(docs), "terms").select("mid", "cls")


def content_similar(spark: SparkSession, folder: str) -> DataFrame:
    return _content_index(spark, folder).neighbours()


def content_similar_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _content_index(spark, folder).counts()


def content_similar_top20(spark: SparkSession, folder: str) -> DataFrame:
    return _content_index(spark, folder).top(20)


def similar_map_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's score with the next id, looked up in the map of its ten best; else 0."""
    best = vector_similar_top10(spark, folder)
    nested = as_recs(best.select(F.col("vec_id").alias("mid"), "rank", "sim_vec_id", "score"), "mid", item="sim_vec_id")
    score = score_in("scores", F.col("mid") + 1)
    return recs_as_map(nested).select(F.col("mid").alias("vec_id"), score.alias("score"))


def content_hashed_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The hashed feature vectors as rows of their non-zero weights."""
    features = content.tfidf(warehouse.items(spark, folder), content.HASHED)
    dense = features.select("mid", F.posexplode(vector_to_array("features")).alias("bucket", "w"))
    return dense.filter("w <> 0").select("mid", "bucket", F.round("w", DIGITS).alias("weight"))


def content_hashed_top20(spark: SparkSession, folder: str) -> DataFrame:
    items = warehouse.items(spark, folder)
    index = content.similar(
        items, variant=content.HASHED, digits=DIGITS, store=_run_store(spark)
    )
    return index.top(20)


# --- vectors and factors ----------------------------------------------------------


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.vectors(spark, folder).select(
        F.col("vec_id").alias("mid"), F.col("embedding").alias("vec")
    )


def vector_similar(spark: SparkSession, folder: str) -> DataFrame:
    index = dense_index(
        _vectors(spark, folder), VECTOR_THRESHOLD, DIGITS, store=_run_store(spark)
    )
    return index.neighbours().withColumnRenamed("mid", "vec_id")


def vector_similar_top10(spark: SparkSession, folder: str) -> DataFrame:
    index = dense_index(
        _vectors(spark, folder), VECTOR_THRESHOLD, DIGITS, keep=11, store=_run_store(spark)
    )
    return (
        index.top(10)
        .withColumnRenamed("mid", "vec_id")
        .withColumnRenamed("sim_mid", "sim_vec_id")
    )


def vector_similar_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of the vectors whose id is divisible by 100, looked for by hashes among all."""
    index = approximate_index(
        _vectors(spark, folder),
        VECTOR_THRESHOLD,
        DIGITS,
        queries=F.col("mid") % 100 == 0,
        store=_run_store(spark),
    )
    lists = index.neighbours().filter(F.col("mid") % 100 == 0)
    return lists.withColumnRenamed("mid", "vec_id")


def vector_cosine(spark: SparkSession, folder: str) -> DataFrame:
    """Cosine of every vector with the first vector of its label."""
    vectors = warehouse.table(spark, folder, "embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    score = F.round(cosine("embedding", "first"), DIGITS)
    return vectors.join(first, "label").select("vec_id", score.alias("score"))


def distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    return factors.distinct_users(warehouse.ratings(spark, folder))


def distinct_items(spark: SparkSession, folder: str) -> DataFrame:
    return factors.distinct_items(warehouse.ratings(spark, folder))


def candidate_grid_count(spark: SparkSession, folder: str) -> DataFrame:
    return factors.candidate_grid_count(warehouse.ratings(spark, folder))


def _model(spark: SparkSession, folder: str):
    """The factor model; queries over the same ratings share one training."""
    models = f"{checkpoint_folder(spark)}/tasteloom/models"
    return factors.stored_model(warehouse.ratings(spark, folder), models)


def als_user_recs(spark: SparkSession, folder: str) -> DataFrame:
    return factors.user_recs(_model(spark, folder))


def als_predictions(spark: SparkSession, folder: str) -> DataFrame:
    ratings = warehouse.ratings(spark, folder)
    pairs = factors.triples(ratings)
    return factors.predict(_model(spark, folder), pairs)


def als_unseen_recs(spark: SparkSession, folder: str) -> DataFrame:
    """The best 20 items of every user that the user has not rated."""
    return factors.unseen_recs(_model(spark, folder), warehouse.ratings(spark, folder))


def als_item_similar_top20(spark: SparkSession, folder: str) -> DataFrame:
    model = _model(spark, folder)
    return factors.item_recs(model, keep=21, store=_run_store(spark)).top(20)


def als_grid(spark: SparkSession, folder: str) -> DataFrame:
    return tuning.grid(warehouse.ratings(spark, folder))


def topk_per_user(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best liked of the items a user has rated, by the mean score of the item."""
    ratings = warehouse.ratings(spark, folder)
    means = statistics.average(ratings).select("mid", F.round("avg", DIGITS).alias("score"))
    rated = ratings.select("uid", "mid").distinct()
    return top_per_key(rated.join(means, "mid"), "uid", 20).select("uid", "rank", "mid", "score")


def _sides(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and score sum on each side of a split."""
    sums = [F.count("*").alias("n"), F.sum("score").alias("score_sum")]
    return train.agg(F.lit("train").alias("side"), *sums).union(
        test.agg(F.lit("test").alias("side"), *sums)
    )


def random_split(spark: SparkSession, folder: str) -> DataFrame:
    return _sides(*tuning.random_split(warehouse.ratings(spark, folder)))


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return _sides(*tuning.hash_split(warehouse.ratings(spark, folder)))


def rmse_item_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Hold-out error of predicting the item mean; every fifth pair value is held out."""
    ratings = warehouse.ratings(spark, folder)
    side = F.pmod(F.col("uid") * 31 + F.col("mid"), F.lit(5))
    train, test = ratings.filter(side != 0), ratings.filter(side == 0)
    means = statistics.average(train).withColumnRenamed("avg", "prediction")
    predicted = test.select("uid", "mid").distinct().join(means, "mid")
    return tuning.rmse(tuning.with_predictions(test, predicted)).select(_rounded("rmse"))


# --- rating messages and real-time scoring ----------------------------------------


def rating_messages(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.rating_events(spark, folder)


def log_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return logs.extract_ratings(warehouse.log_lines(spark, folder))


def last_events(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.last_events(spark, folder)


def recent_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return recent(warehouse.ratings(spark, folder))


def recent_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Recent ratings as ``MID:SCORE`` list entries, parsed again."""
    entries = recent(warehouse.ratings(spark, folder)).select(
        "uid", "pos", F.concat_ws(" : ", "mid", "score").alias("value")
    )
    return text.parse_recent_entries(entries)


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.ratings(spark, folder).select("uid", "mid")


def _recent_of_batch(spark: SparkSession, folder: str, events: DataFrame) -> DataFrame:
    return recent(realtime.of_users(warehouse.ratings(spark, folder), events))


def _batch(spark: SparkSession, folder: str) -> DataFrame:
    """The last event of each user, written once: the scoring reads it many times."""
    return settled(last_events(spark, folder), _run_store(spark), "batch")


def event_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return realtime.candidates(
        _batch(spark, folder),
        _content_index(spark, folder),
        _rated(spark, folder),
        store=_run_store(spark),
    )


def pair_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Similarity of each user's last event item to the user's recent items."""
    events = _batch(spark, folder).select("uid", "mid")
    recents = _recent_of_batch(spark, folder, events)
    pairs = events.join(recents.select("uid", F.col("mid").alias("recent_mid")), "uid")
    return realtime.pair_similarity(pairs, _content_index(spark, folder), "mid", "recent_mid")


def realtime_scores(spark: SparkSession, folder: str) -> DataFrame:
    events, index = _batch(spark, folder), _content_index(spark, folder)
    found = realtime.candidates(events, index, _rated(spark, folder), store=_run_store(spark))
    scored = realtime.score(found, _recent_of_batch(spark, folder, events), index)
    return _final_scores(scored)


def _final_scores(scored: DataFrame) -> DataFrame:
    """Round, then rank by the rounded score, so that the last bit decides no order.

    Scores are means of six-digit numbers and often end on a 5 in the seventh place.
    Rounding to nine places first takes the summation noise off those.
    """
    rows = scored.select("uid", "mid", F.round(F.round("score", 9), DIGITS).alias("score"))
    return top_per_key(rows, "uid", None).select("uid", "rank", "mid", "score")


def realtime_list_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Users of a batch and the length of their list, empty lists included."""
    events = _batch(spark, folder)
    recs = realtime.recommend(
        events,
        _content_index(spark, folder),
        _rated(spark, folder),
        _recent_of_batch(spark, folder, events),
        store=_run_store(spark),
    )
    return recs.select("uid", F.size("recs").alias("n"))


def latest_user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Daily batches with one row per user, reduced to the newest batch of each user."""
    events = warehouse.rating_events(spark, folder)
    day = F.floor(F.col("timestamp") / 86400)
    batches = one_per_key(
        events.withColumn("batch_id", day),
        ["uid", "batch_id"],
        [F.desc("timestamp"), F.asc("mid"), F.desc("score")],
    )
    return latest_of(batches, "uid")


def _message_folder(messages: DataFrame, store: Store) -> str:
    path = store.path("messages")
    messages.write.text(path)
    return path


def stream_log_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The log extraction as a streaming query over all log lines."""
    store = _run_store(spark)
    lines = file_lines(spark, _message_folder(warehouse.log_lines(spark, folder), store))
    query = logs.start_extraction(lines, store.path("progress"), store.path("out"))
    query.awaitTermination()
    return spark.read.schema("key string, value string").parquet(store.path("out"))


def stream_log_topology(spark: SparkSession, folder: str) -> DataFrame:
    """The same extraction as one job from a source of lines to a sink of messages."""
    store = _run_store(spark)
    lines = file_lines(spark, _message_folder(warehouse.log_lines(spark, folder), store))
    sink = FolderSink(store.path("out"))
    logs.start_topology(lines, sink, store.path("progress"), availableNow=True).awaitTermination()
    return sink.read(spark)


def stream_realtime(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring stream over all rating messages, read back as the latest lists.

    The content similarity, the rated items and the recent ratings are published first as
    one snapshot, and looked up by key in every batch.
    """
    store = _run_store(spark)
    messages = _message_folder(warehouse.rating_messages(spark, folder), store)
    write_table(warehouse.ratings(spark, folder), store, RATING_TABLE)
    jobs.publish_lookups(spark, store, _content_index(spark, folder, store))
    query = recommend.start(
        file_lines(spark, messages),
        jobs.snapshot_inputs(store),
        store,
        store.path("progress"),
        availableNow=True,
    )
    query.awaitTermination()
    lists = recommend.latest_recs(spark, store)
    return _final_scores(lists.select("uid", F.inline("recs")))


def stream_recent_state(spark: SparkSession, folder: str) -> DataFrame:
    """Recent ratings as a stream keeps them: the stored ones, then its own messages."""
    store = _run_store(spark)
    messages = _message_folder(warehouse.rating_messages(spark, folder), store)
    query = recommend.keep_recent(
        file_lines(spark, messages),
        recent(warehouse.ratings(spark, folder)),
        store,
        store.path("progress"),
        availableNow=True,
    )
    query.awaitTermination()
    return recommend.recent_now(spark, store)


def stream_recent_in_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same ratings held in the stream's state store, over several batches of messages."""
    store = _run_store(spark)
    path = store.path("messages")
    warehouse.rating_messages(spark, folder).repartition(4).write.text(path)
    query = state.keep_recent_in_stream(
        file_lines(spark, path, maxFilesPerTrigger="1"),
        recent(warehouse.ratings(spark, folder)),
        store,
        store.path("progress"),
        availableNow=True,
    )
    query.awaitTermination()
    return recommend.recent_now(spark, store)


def stream_realtime_in_state(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring stream with its recents in the state store, read back as the latest lists."""
    store = _run_store(spark)
    messages = _message_folder(warehouse.rating_messages(spark, folder), store)
    ratings = warehouse.ratings(spark, folder)
    write_table(ratings, store, RATING_TABLE)
    jobs.publish_lookups(spark, store, _content_index(spark, folder, store))
    query = state.start_in_stream(
        file_lines(spark, messages),
        jobs.snapshot_inputs(store),
        recent(ratings),
        store,
        store.path("progress"),
        availableNow=True,
    )
    query.awaitTermination()
    lists = recommend.latest_recs(spark, store)
    return _final_scores(lists.select("uid", F.inline("recs")))


def replaced_under_reader(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced twice while an earlier reader has yet to finish: what each one sees."""
    store = replace(_run_store(spark), versioned=True)
    ratings = warehouse.ratings(spark, folder)
    write_table(ratings, store, RATING_TABLE)
    early = read_table(spark, store, RATING_TABLE, RATING)
    write_table(ratings.filter("score >= 3"), store, RATING_TABLE, ["uid", "mid"])
    write_table(ratings.filter("score < 3"), store, RATING_TABLE)
    late = read_table(spark, store, RATING_TABLE, RATING)
    sums = [F.count("*").alias("n"), F.sum("score").alias("score_sum")]
    return early.agg(F.lit("early").alias("reader"), *sums).union(
        late.agg(F.lit("late").alias("reader"), *sums)
    )


def merged_user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Daily batches upserted and merged every few of them; then the newest row of each user."""
    store = _run_store(spark)
    daily = one_per_key(
        warehouse.rating_events(spark, folder).withColumn(
            "batch_id", F.floor(F.col("timestamp") / 86400)
        ),
        ["uid", "batch_id"],
        [F.desc("timestamp"), F.asc("mid"), F.desc("score")],
    )
    fields = [f for f in RATING.fields if f.name != "uid"]
    schema = T.StructType([RATING["uid"], *fields, T.StructField("day", T.LongType())])
    rows = settled(daily.withColumn("day", F.col("batch_id")), store, "Daily")
    low, high = rows.agg(F.min("day"), F.max("day")).first()
    cuts = [low + (high + 1 - low) * i // 4 for i in range(5)]
    for first, end in zip(cuts, cuts[1:]):
        part = rows.filter((F.col("day") >= first) & (F.col("day") < end))
        upsert_batches(part, store, "Events")
        merge_batches(spark, store, "Events", schema, "uid", before=end - 1)
    found = latest(spark, store, "Events", schema, "uid")
    return found.withColumnRenamed("day", "batch_id")


def keyed_document_table(spark: SparkSession, folder: str) -> DataFrame:
    """The keyed search table written over an earlier one and read back."""
    store = replace(_run_store(spark), versioned=True)
    found = tags.items_with_tags(warehouse.items(spark, folder), warehouse.tags(spark, folder))
    earlier = found.withColumn("name", F.lit("earlier"))
    write_keyed(earlier, store, SEARCH_TABLE, "mid", ["name"])
    later = found.unionByName(found.withColumn("name", F.concat("name", F.lit("~"))))
    write_keyed(later, store, SEARCH_TABLE, "mid", ["name"])
    return read_table(spark, store, SEARCH_TABLE, found.schema)


def entry(spark: SparkSession) -> DataFrame:
    """The best rated items of every category."""
    return genres_top(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        genres_top,
        rate_more_items,
        rate_more_recently,
        average_items,
        monthly_scores,
        genre_matches,
        item_tags,
        items_with_tags,
        parsed_items,
        parsed_ratings,
        parsed_tags,
        rejected_lines,
        stored_ratings,
        colocated_item_scores,
        keyed_tags,
        content_term_weights,
        content_idf,
        content_classes,
        content_similar,
        content_similar_counts,
        content_similar_top20,
        content_hashed_weights,
        content_hashed_top20,
        vector_similar,
        vector_similar_top10,
        vector_similar_approx,
        vector_cosine,
        similar_map_lookup,
        distinct_users,
        distinct_items,
        candidate_grid_count,
        topk_per_user,
        rmse_item_mean,
        als_user_recs,
        als_unseen_recs,
        als_predictions,
        als_item_similar_top20,
        als_grid,
        random_split,
        hash_split,
        rating_messages,
        log_ratings,
        last_events,
        recent_ratings,
        recent_entries,
        event_candidates,
        pair_similarity,
        realtime_scores,
        realtime_list_sizes,
        latest_user_events,
        stream_log_ratings,
        stream_log_topology,
        stream_realtime,
        stream_recent_state,
        stream_recent_in_state,
        stream_realtime_in_state,
        replaced_under_reader,
        merged_user_events,
        keyed_document_table,
    ]
    named = {query.__name__: query for query in found}
    named["sql_rate_more_items"] = _statistic_by_sql("rate_more")
    named["sql_rate_more_recently"] = _statistic_by_sql("rate_more_recently")
    named["sql_average_items"] = _statistic_by_sql("average")
    named.update(llm.queries() if llm else {})
    return named


def oracle_sql() -> dict[str, str]:
    import oracle

    return oracle.SQL | (llm_sql.SQL if llm_sql else {})
