"""Row features, predicates and joins."""


from ledgerflow.catalog.registry import query
from ledgerflow.catalog.sources import NARROW, PATTERN_SQL
from ledgerflow.functions import features as f
from ledgerflow.ml.features import label_encode
from ledgerflow.operators import enrich, predicates
from ledgerflow.operators.aggregates import top_customers
from ledgerflow.plans.adapter_sql import oracle
from ledgerflow.sources import io

TS = '"timestamp"'


def from_tx(columns: str, source: str = "tx") -> str:
    return oracle(source, f"SELECT transaction_id, {columns} FROM {source}")


def column(name: str, sql: str, source: str = "tx"):
    """A query that shows one added column next to the id."""
    return query(name, from_tx(sql, source))


@query(
    "calendar_parts",
    from_tx(f"hour({TS}) AS hour, dayofweek({TS}) + 1 AS day_of_week, month({TS}) AS month, year({TS}) AS year"),
)
def _(star):
    return f.calendar_parts(star.tx).select("transaction_id", "hour", "day_of_week", "month", "year")


@query("calendar_parts_monday0", from_tx(f"hour({TS}) AS hour, isodow({TS}) - 1 AS day_of_week, month({TS}) AS month"))
def _(star):
    return f.calendar_parts_monday0(star.tx).select("transaction_id", "hour", "day_of_week", "month")


@column("month_name", f"strftime({TS}, '%b') AS month_name")
def _(star):
    return f.month_name(star.tx).select("transaction_id", "month_name")


@column("is_weekend", f"CASE WHEN isodow({TS}) >= 6 THEN 1 ELSE 0 END AS is_weekend")
def _(star):
    return f.is_weekend(star.tx).select("transaction_id", "is_weekend")


@column("is_night", f"CASE WHEN hour({TS}) <= 5 THEN 1 ELSE 0 END AS is_night")
def _(star):
    return f.is_night(star.tx).select("transaction_id", "is_night")


@column(
    "time_of_day",
    f"""CASE WHEN hour({TS}) BETWEEN 6 AND 11 THEN 'morning' WHEN hour({TS}) BETWEEN 12 AND 17 THEN 'afternoon'
        WHEN hour({TS}) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day""",
)
def _(star):
    return f.time_of_day(star.tx).select("transaction_id", "time_of_day")


@column(
    "amount_band",
    """CASE WHEN amount < 500 THEN 'small' WHEN amount < 5000 THEN 'medium' WHEN amount < 20000 THEN 'large'
       ELSE 'very_large' END AS amount_category""",
    "tx_raw",
)
def _(star):
    return f.amount_band(star.tx_raw).select("transaction_id", "amount_category")


@column(
    "amount_bin_right",
    """CASE WHEN amount > 0 AND amount <= 500 THEN 'small' WHEN amount > 500 AND amount <= 5000 THEN 'medium'
       WHEN amount > 5000 AND amount <= 20000 THEN 'large' WHEN amount > 20000 THEN 'very_large' END AS amount_bin""",
    "tx_raw",
)
def _(star):
    return f.amount_bin_right(star.tx_raw).select("transaction_id", "amount_bin")


@column("tx_direction", "tx_direction", "featured")
def _(star):
    return f.tx_direction(star.tx).select("transaction_id", "tx_direction")


@column(
    "suspicious_batch",
    "CAST(amount > 30000 OR status = 'failed' AS INTEGER) AS is_suspicious",
    "tx_raw",
)
def _(star):
    return f.suspicious_batch(star.tx_raw).select("transaction_id", "is_suspicious")


@query(
    "suspicious_dashboard",
    oracle(
        "joined",
        """SELECT transaction_id, city, CAST(amount AS DOUBLE) AS amount, status FROM joined
           WHERE amount > 30000 OR status IN ('failed', 'reversed')""",
    ),
)
def _(star):
    return f.suspicious_dashboard(star.full).select("transaction_id", "city", "amount", "status")


@column("fraud_label", "is_fraud", "labelled")
def _(star):
    return f.fraud_label(star.tx, rows=star.rows).select("transaction_id", "is_fraud")


@column("fraud_label_ranked", "is_fraud", "labelled")
def _(star):
    return f.fraud_label(star.tx, levels=NARROW).select("transaction_id", "is_fraud")


@column("amount_to_balance", "CAST(amount AS DOUBLE) / (CAST(balance AS DOUBLE) + 1.0) AS amount_to_balance", "joined")
def _(star):
    return f.amount_to_balance(star.full).select("transaction_id", "amount_to_balance")


@query(
    "rule_flags",
    oracle("flagged", "SELECT transaction_id, array_to_string(fraud_flags, '; ') AS fraud_flags FROM flagged"),
)
def _(star):
    return f.rule_flags(star.live).select("transaction_id", "fraud_flags")


@column("is_flagged", "is_fraud", "events_done")
def _(star):
    return f.is_flagged(f.rule_flags(star.live)).select("transaction_id", "is_fraud")


@column("alert_text", "CASE WHEN is_fraud = 1 THEN array_to_string(fraud_flags, ',') ELSE 'OK' END AS alert", "events_done")
def _(star):
    return f.alert_text(f.rule_flags(star.live)).select("transaction_id", "alert")


CODES = "(SELECT row_number() OVER (ORDER BY v) - 1 AS code, v FROM (SELECT DISTINCT coalesce({c}, 'unknown') AS v FROM {t}))"


def codes_sql(col: str, table: str) -> str:
    return CODES.format(c=col, t=table)


@query(
    "label_encode",
    oracle(
        "joined",
        f"""SELECT j.transaction_id, CAST(a.code AS INTEGER) AS tx_type_enc, CAST(b.code AS INTEGER) AS account_type_enc,
              CAST(c.code AS INTEGER) AS status_enc, CAST(d.code AS INTEGER) AS city_enc FROM joined j
            JOIN {codes_sql('tx_type', 'joined')} a ON a.v = coalesce(j.tx_type, 'unknown')
            JOIN {codes_sql('account_type', 'joined')} b ON b.v = coalesce(j.account_type, 'unknown')
            JOIN {codes_sql('status', 'joined')} c ON c.v = coalesce(j.status, 'unknown')
            JOIN {codes_sql('city', 'joined')} d ON d.v = coalesce(j.city, 'unknown')""",
    ),
)
def _(star):
    cols = ("tx_type", "account_type", "status", "city")
    return label_encode(star.full, cols).select("transaction_id", *[f"{c}_enc" for c in cols])


@query(
    "label_encode_joined",
    oracle(
        "joined",
        f"""SELECT j.transaction_id, CAST(b.code AS INTEGER) AS account_type_enc, CAST(d.code AS INTEGER) AS city_enc FROM joined j
            JOIN {codes_sql('account_type', 'joined')} b ON b.v = coalesce(j.account_type, 'unknown')
            JOIN {codes_sql('city', 'joined')} d ON d.v = coalesce(j.city, 'unknown')""",
    ),
)
def _(star):
    cols = ("account_type", "city")
    return label_encode(star.full, cols, broadcast_bytes=0).select("transaction_id", *[f"{c}_enc" for c in cols])


@column("unit_scale", "CAST(amount AS DOUBLE) / 1000.0 AS thousands, CAST(amount AS DOUBLE) / 1000000.0 AS millions")
def _(star):
    scaled = f.unit_scale(f.unit_scale(star.tx, "amount", 1e3, "thousands"), "amount", 1e6, "millions")
    return scaled.select("transaction_id", "thousands", "millions")


# ---- predicates -------------------------------------------------------------------------------------------------


@query(
    "filter_direction",
    oracle(
        "featured",
        "SELECT transaction_id, tx_type, CAST(amount AS DOUBLE) AS amount FROM featured WHERE tx_direction = 'outflow'",
    ),
)
def _(star):
    kept = enrich.filter_direction(f.tx_direction(star.tx), "outflow")
    return kept.select("transaction_id", "tx_type", "amount")


@query("fraud_pattern", oracle("joined", PATTERN_SQL))
def _(star):
    return predicates.fraud_pattern(star.full)


@query("fraud_pattern_sql", oracle("joined", PATTERN_SQL + " ORDER BY joined.amount DESC, transaction_id LIMIT 8"))
def _(star):
    io.register(star.spark, star.full, star.tx, star.accounts, star.customers)
    return predicates.fraud_pattern_sql(star.spark, 8)


@query(
    "flagged_list",
    oracle(
        "events_done",
        "SELECT transaction_id, city, CAST(amount AS DOUBLE) AS amount, tx_type, status FROM events_done WHERE is_fraud = 1",
    ),
)
def _(star):
    return predicates.flagged_list(f.is_flagged(f.rule_flags(star.live)))


@query(
    "select_preview",
    oracle(
        "joined",
        """SELECT transaction_id, name, city, account_type, CAST(amount AS DOUBLE) AS amount, tx_type, status
           FROM joined ORDER BY "timestamp", transaction_id LIMIT 8""",
    ),
)
def _(star):
    cols = ("transaction_id", "name", "city", "account_type", "amount", "tx_type", "status")
    return enrich.preview(star.full, cols, 8, ("timestamp", "transaction_id"))


# ---- joins ------------------------------------------------------------------------------------------------------

J1_SQL = (
    "SELECT t.transaction_id, t.account_id, CAST(t.amount AS DOUBLE) AS amount, t.status, a.customer_id, a.account_type, "
    "CAST(a.balance AS DOUBLE) AS balance FROM tx t LEFT JOIN accounts a ON t.account_id = a.account_id"
)


@query("tx_accounts", oracle("tx accounts", J1_SQL))
def _(star):
    cols = ("transaction_id", "account_id", "amount", "status", "customer_id", "account_type", "balance")
    return enrich.tx_accounts(star.tx_plan, star.accounts).select(*cols)


@query(
    "tx_customers",
    oracle(
        "accounts customers",
        """SELECT a.account_id, a.customer_id, a.account_type, c.name, c.city, c.age FROM accounts a
           LEFT JOIN customers c ON a.customer_id = c.customer_id""",
    ),
)
def _(star):
    cols = ("account_id", "customer_id", "account_type", "name", "city", "age")
    return enrich.tx_customers(star.accounts, star.customers).select(*cols)


@query(
    "enrich",
    oracle(
        "joined",
        """SELECT transaction_id, account_id, customer_id, account_type, CAST(balance AS DOUBLE) AS balance, name, city, age,
             CAST(amount AS DOUBLE) AS amount, tx_type, tx_direction, "timestamp", status, merchant, category FROM joined""",
    ),
)
def _(star):
    return star.full_plan


@query(
    "topn_names",
    oracle(
        "joined",
        """SELECT t.customer_id, CAST(t.amount AS DOUBLE) AS amount, c.name FROM (
             SELECT customer_id, sum(amount) AS amount FROM joined WHERE customer_id IS NOT NULL GROUP BY 1
             ORDER BY 2 DESC, 1 LIMIT 10) t JOIN customers c ON c.customer_id = t.customer_id""",
    ),
)
def _(star):
    return enrich.topn_names(top_customers(star.full, 10), star.customers)


@query("order_by", oracle("joined", "SELECT transaction_id, city, CAST(amount AS DOUBLE) AS amount FROM joined"))
def _(star):
    return enrich.order_by(star.full.select("transaction_id", "city", "amount"), "city", "-amount", "transaction_id")


@query(
    "top_k",
    oracle(
        "joined",
        """SELECT transaction_id, CAST(amount AS DOUBLE) AS amount FROM joined
           ORDER BY joined.amount DESC, transaction_id LIMIT 100""",
    ),
)
def _(star):
    return enrich.top_k(star.full.select("transaction_id", "amount"), ["-amount"], 100, "transaction_id")


