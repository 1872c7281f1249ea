"""Streaming queries: each runs its stream to the end and reads the sink."""

from ledgerflow.catalog.registry import query
from ledgerflow.operators import predicates
from ledgerflow.plans.adapter_sql import oracle, share
from ledgerflow.settings import scratch_dir
from ledgerflow.streaming import live as s

RECORD = "transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, tx_type, \"timestamp\", status, city"
FLAGS = "array_to_string(fraud_flags, '; ') AS fraud_flags"


def finished(star, stream, mode="append"):
    """Runs the stream over all input and returns what the sink holds."""
    sink = scratch_dir(star.spark, "sink")
    run = s.start(stream, sink, scratch_dir(star.spark, "progress"), mode, trigger=None)
    run.awaitTermination()
    return s.current(star.spark, sink, stream.schema) if mode == "complete" else star.spark.read.schema(stream.schema).parquet(sink)


@query("file_stream", oracle("live", f"SELECT {RECORD} FROM live"))
def _(star):
    return finished(star, star.live_stream())


@query("high_amount_stream", oracle("live", f"SELECT {RECORD}, 'HIGH_AMOUNT' AS fraud_flag FROM live WHERE amount > 40000"))
def _(star):
    return finished(star, s.high_amount_stream(star.live_stream()))


@query(
    "append_sink",
    oracle(
        "events_done",
        "SELECT transaction_id, city, CAST(amount AS DOUBLE) AS amount, tx_type, status FROM events_done WHERE is_fraud = 1",
    ),
)
def _(star):
    return finished(star, predicates.flagged_list(s.flag_stream(star.live_stream())))


@query("flag_stream", oracle("events_done", f"SELECT {RECORD}, {FLAGS}, is_fraud FROM events_done"))
def _(star):
    return finished(star, s.flag_stream(star.live_stream()))


@query(
    "alert_stream",
    oracle(
        "events_done",
        f"""SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, {FLAGS}, "timestamp" FROM events_done WHERE is_fraud = 1""",
    ),
)
def _(star):
    return finished(star, s.alert_stream(s.flag_stream(star.live_stream())))


@query(
    "running_stats",
    oracle(
        "events_done",
        """SELECT count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS flagged, CAST(sum(amount) AS DOUBLE) AS volume
           FROM events_done""",
    ),
)
def _(star):
    return finished(star, s.running_stats(s.flag_stream(star.live_stream())), "complete")


@query("running_by_type", oracle("live", "SELECT tx_type, count(*) AS count FROM live GROUP BY 1"))
def _(star):
    return finished(star, s.running_by_type(star.live_stream()), "complete")


@query(
    "city_rate_stream",
    oracle(
        "events_done",
        f"""SELECT city, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
            {share('sum(is_fraud)', 'count(*)')} AS fraud_rate_pct FROM events_done GROUP BY city""",
    ),
)
def _(star):
    return finished(star, s.city_rate_stream(s.flag_stream(star.live_stream())), "complete")


@query(
    "type_volume_stream",
    oracle("live", "SELECT tx_type, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS total_amount FROM live GROUP BY 1"),
)
def _(star):
    return finished(star, s.type_volume_stream(star.live_stream()), "complete")


@query("stream_archive", oracle("events_done", f"SELECT {RECORD}, {FLAGS}, is_fraud FROM events_done"))
def _(star):
    sink = scratch_dir(star.spark, "archive")
    stream = s.flag_stream(star.live_stream())
    s.stream_archive(stream, sink, scratch_dir(star.spark, "progress"), trigger=None).awaitTermination()
    return star.spark.read.schema(stream.schema).parquet(sink)
