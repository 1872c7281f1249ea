"""The adapter, cleaning and joins as SQL text for a comparison engine."""

HALF = "CAST(floor(round(l_extendedprice * 100) / 2) / 1e2 AS DECIMAL(18,2))"

# name -> (text, names it needs)
PARTS = {
    "customers_raw": (
        """SELECT c_custkey AS customer_id, c_name AS name,
             CASE WHEN c_custkey % 33 = 5 THEN NULL ELSE CAST(18 + c_custkey % 58 AS INTEGER) END AS age,
             CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE n_name END AS city
           FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 89 <> 0""",
        (),
    ),
    "accounts_raw": (
        """SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderpriority AS account_type,
             CASE WHEN o_orderkey % 50 = 11 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS balance,
             o_orderdate AS open_date, o_orderstatus AS status
           FROM orders WHERE o_orderkey % 97 <> 0""",
        (),
    ),
    "tx_raw": (
        f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS account_id,
             CASE WHEN l_partkey % 50 = 3 THEN NULL WHEN l_partkey % 33 = 1 THEN -{HALF} ELSE {HALF} END AS amount,
             CASE WHEN l_partkey % 50 = 13 THEN NULL ELSE
               CASE l_suppkey % 5 WHEN 0 THEN 'credit' WHEN 1 THEN 'debit' WHEN 2 THEN 'transfer'
                 WHEN 3 THEN 'withdrawal' ELSE 'payment' END END AS tx_type,
             l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS "timestamp",
             CASE WHEN l_quantity <= 37 THEN 'completed' WHEN l_quantity <= 42 THEN 'pending'
               WHEN l_quantity <= 47 THEN 'failed' ELSE 'reversed' END AS status,
             l_suppkey AS merchant, p_type AS category, l_partkey AS part_id
           FROM lineitem JOIN part ON l_partkey = p_partkey""",
        (),
    ),
    "live": (
        """SELECT event_id AS transaction_id, user_id AS account_id, CAST(value * 250 AS DECIMAL(18,2)) AS amount,
             CASE event_type WHEN 'view' THEN 'credit' WHEN 'click' THEN 'debit' WHEN 'signup' THEN 'transfer'
               WHEN 'error' THEN 'withdrawal' WHEN 'purchase' THEN 'payment' END AS tx_type,
             ts AS "timestamp",
             CASE WHEN event_id % 20 < 15 THEN 'completed' WHEN event_id % 20 < 17 THEN 'pending'
               WHEN event_id % 20 < 19 THEN 'failed' ELSE 'reversed' END AS status,
             n_name AS city
           FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
        (),
    ),
    "flagged": (
        """SELECT *, list_filter([
               CASE WHEN amount > 40000 THEN 'HIGH_AMOUNT' END,
               CASE WHEN status IN ('failed', 'reversed') AND amount > 10000 THEN 'FAILED_HIGH_TX' END,
               CASE WHEN tx_type = 'withdrawal' AND amount > 30000 THEN 'LARGE_WITHDRAWAL' END
             ], lambda f: f IS NOT NULL) AS fraud_flags
           FROM live""",
        ("live",),
    ),
    "events_done": ("SELECT *, CASE WHEN len(fraud_flags) > 0 THEN 1 ELSE 0 END AS is_fraud FROM flagged", ("flagged",)),
    "customers": (
        """SELECT customer_id, name, coalesce(age, 0) AS age, coalesce(city, 'Unknown') AS city FROM customers_raw
           WHERE customer_id IS NOT NULL AND name IS NOT NULL AND coalesce(age, 0) >= 0
           QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY name) = 1""",
        ("customers_raw",),
    ),
    "accounts": (
        """SELECT account_id, customer_id, account_type, coalesce(balance, 0) AS balance, open_date, status
           FROM accounts_raw WHERE account_id IS NOT NULL AND customer_id IS NOT NULL AND coalesce(balance, 0) >= 0
           QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY customer_id) = 1""",
        ("accounts_raw",),
    ),
    "tx": (
        """SELECT transaction_id, account_id, amount, tx_type, "timestamp", status, merchant, category FROM tx_raw
           WHERE account_id IS NOT NULL AND tx_type IS NOT NULL AND amount > 0
           QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY "timestamp", part_id, merchant, amount, status) = 1""",
        ("tx_raw",),
    ),
    "featured": (
        """SELECT *, CASE WHEN tx_type = 'credit' THEN 'inflow' WHEN tx_type IN ('debit', 'withdrawal', 'payment')
             THEN 'outflow' ELSE 'neutral' END AS tx_direction FROM tx""",
        ("tx",),
    ),
    "joined": (
        """SELECT f.*, a.customer_id, a.account_type, a.balance, c.name, c.city, c.age FROM featured f
           LEFT JOIN accounts a ON f.account_id = a.account_id LEFT JOIN customers c ON a.customer_id = c.customer_id""",
        ("featured", "accounts", "customers"),
    ),
    "cut_off": ("SELECT quantile_cont(CAST(amount AS DOUBLE), 0.98) AS q98 FROM tx", ("tx",)),
    "labelled": (
        """SELECT *, CASE WHEN (amount > 30000 AND status IN ('failed', 'reversed'))
               OR (CAST(amount AS DOUBLE) > (SELECT q98 FROM cut_off) AND status = 'failed')
               OR (hour("timestamp") BETWEEN 1 AND 4 AND amount > 20000) THEN 1 ELSE 0 END AS is_fraud
           FROM joined""",
        ("joined", "cut_off"),
    ),
    "spend": (
        """SELECT customer_id, name, city, count(transaction_id) AS total_transactions, sum(amount) AS total_spend,
             max(amount) AS max_single_tx, CAST(sum(amount) * 100 AS HUGEINT) AS spend_cents
           FROM joined WHERE tx_direction = 'outflow' GROUP BY customer_id, name, city""",
        ("joined",),
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(PARTS[name][1], seen)
            seen.append(name)
    return seen


def oracle(uses: str, body: str, **more: str) -> str:
    """``body`` below the common table expressions it uses; ``more`` adds local ones in order."""
    parts = [f"{n} AS ({PARTS[n][0]})" for n in _needed(tuple(uses.split()), [])]
    parts += [f"{n} AS ({text})" for n, text in more.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def share(part: str, whole: str, scale: int = 1000, divisor: str = "10.0") -> str:
    """Ratio rounded half up in whole numbers: percent with one decimal by default."""
    return f"CAST((2 * {scale} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / {divisor}"


def mean_cents(total: str, count: str) -> str:
    """Average money in whole cents."""
    return f"CAST((2 * CAST({total} * 100 AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE) / 100.0"
