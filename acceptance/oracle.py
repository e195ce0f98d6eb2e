"""The SQL each query must match; DuckDB runs it over the same tables."""

from __future__ import annotations

# Derived relations, dependencies first.
RELATIONS = {
    "cust_v1": """
        SELECT c_custkey AS k, c_name AS nm, c_mktsegment AS seg, c_nationkey AS nk
        FROM customer
        WHERE c_custkey % 10 <> 3
    """,
    "cust_v2": """
        SELECT c_custkey AS k, c_name AS nm, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE
        c_mktsegment END AS seg, c_nationkey AS nk
        FROM customer
        WHERE c_custkey % 11 <> 5
    """,
    "dim_cards": """
        SELECT o_orderkey AS card_num, o_custkey AS account_num, o_orderdate AS effective_from, CASE
        WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 9000 DAY - INTERVAL 1 SECOND ELSE
        TIMESTAMP '2999-12-31 00:00:00' END AS effective_to, CASE WHEN o_orderkey % 17 = 0 THEN 'Y'
        ELSE 'N' END AS deleted_flg
        FROM orders
    """,
    "dim_accounts": """
        SELECT c_custkey AS account_num, TIMESTAMP '2023-01-01 00:00:00' + to_days((c_custkey %
        800)::INT) AS valid_to, c_custkey AS client, TIMESTAMP '1990-01-01 00:00:00' AS
        effective_from, TIMESTAMP '2999-12-31 00:00:00' AS effective_to, 'N' AS deleted_flg
        FROM customer
    """,
    "dim_clients": """
        SELECT c_custkey AS client_id, c_name AS last_name, c_mktsegment AS first_name, CASE WHEN
        c_custkey % 4 = 0 THEN NULL ELSE n_name END AS patronymic, 'P' || c_custkey AS passport_num,
        CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE TIMESTAMP '2023-06-01 00:00:00' +
        to_days((c_custkey % 900)::INT) END AS passport_valid_to, '+7' || c_custkey AS phone,
        TIMESTAMP '1990-01-01 00:00:00' AS effective_from, TIMESTAMP '2999-12-31 00:00:00' AS
        effective_to, 'N' AS deleted_flg
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey
    """,
    "fact_blacklist": """
        SELECT DISTINCT 'P' || user_id AS passport_num, date_trunc('day', ts) AS entry_dt
        FROM events
        WHERE event_type = 'error'
    """,
    "fact_tx": """
        SELECT l_orderkey AS card_num, l_shipdate AS trans_date
        FROM lineitem
    """,
    "acct_changes": """
        SELECT o_custkey AS account_num, o_orderdate AS create_dt, CASE WHEN o_orderkey % 3 = 0 THEN
        o_orderdate + INTERVAL 5 DAY END AS update_dt, max(o_orderstatus) AS status
        FROM orders
        GROUP BY ALL
    """,
    "card_history": """
        SELECT o_orderkey AS card_num, o_custkey AS account_num, o_orderdate AS effective_from,
        o_orderdate + to_days((o_orderkey % 40 + 10)::INT) - INTERVAL 1 SECOND AS effective_to,
        'N' AS deleted_flg
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey + 1, o_orderdate + to_days((o_orderkey % 40 + 10)::INT),
        TIMESTAMP '2999-12-31 00:00:00', CASE WHEN o_orderkey % 17 = 0 THEN 'Y' ELSE 'N' END
        FROM orders
    """,
    "account_history": """
        SELECT account_num, change_ts + to_days((account_num % 90 + 20)::INT) AS valid_to,
        account_num AS client, change_ts AS effective_from, coalesce(lead(change_ts) OVER (PARTITION
        BY account_num ORDER BY change_ts) - INTERVAL 1 SECOND, TIMESTAMP '2999-12-31 00:00:00') AS
        effective_to, CASE WHEN status = 'P' THEN 'Y' ELSE 'N' END AS deleted_flg
        FROM (SELECT account_num, coalesce(update_dt, create_dt) AS change_ts, max(status) AS status
        FROM acct_changes
        GROUP BY ALL)
    """,
    "client_history": """
        SELECT client_id, last_name, first_name, patronymic, phone, passport_num, TIMESTAMP
        '1996-01-01 00:00:00' + to_days((client_id % 1000)::INT) AS passport_valid_to, TIMESTAMP
        '1990-01-01 00:00:00' AS effective_from, TIMESTAMP '1996-01-01 00:00:00' + to_days((client_id
        % 1000)::INT) - INTERVAL 1 SECOND AS effective_to
        FROM dim_clients
        UNION ALL
        SELECT client_id, last_name, first_name, patronymic, phone, 'Q' || client_id, TIMESTAMP
        '1996-01-01 00:00:00' + to_days((client_id % 1000 + client_id % 700)::INT), TIMESTAMP
        '1996-01-01 00:00:00' + to_days((client_id % 1000)::INT), TIMESTAMP '2999-12-31 00:00:00'
        FROM dim_clients
    """,
    "at_event": """
        SELECT f.card_num, f.trans_date, c.account_num, a.valid_to, p.*
        FROM fact_tx f
        JOIN card_history c ON f.card_num = c.card_num AND f.trans_date BETWEEN c.effective_from AND
        c.effective_to AND c.deleted_flg = 'N'
        JOIN account_history a ON c.account_num = a.account_num AND f.trans_date BETWEEN
        a.effective_from AND a.effective_to AND a.deleted_flg = 'N'
        JOIN client_history p ON a.client = p.client_id AND f.trans_date BETWEEN p.effective_from AND
        p.effective_to
        WHERE f.trans_date <= TIMESTAMP '2024-01-15 23:59:59'
    """,
    "enriched": """
        SELECT f.trans_date, a.valid_to, p.*
        FROM fact_tx f
        JOIN dim_cards c ON f.card_num = c.card_num AND f.trans_date <= TIMESTAMP '2024-01-15
        23:59:59' AND TIMESTAMP '2024-01-15 23:59:59' BETWEEN c.effective_from AND c.effective_to
        AND c.deleted_flg = 'N'
        JOIN dim_accounts a ON c.account_num = a.account_num AND TIMESTAMP '2024-01-15 23:59:59'
        BETWEEN a.effective_from AND a.effective_to AND a.deleted_flg = 'N'
        JOIN dim_clients p ON a.client = p.client_id AND TIMESTAMP '2024-01-15 23:59:59' BETWEEN
        p.effective_from AND p.effective_to AND p.deleted_flg = 'N'
    """,
}

# Query name -> the derived relations it needs, and its statement.
STATEMENTS: dict[str, tuple[str, str]] = {
    "src_delimited": (
        "",
        """
        SELECT o_orderkey AS transaction_id, o_orderdate AS trans_date, CAST(o_totalprice AS
        DECIMAL(18,2)) AS amt, '"' || o_orderstatus || '" ' || chr(92) || '; "x' || chr(92) AS note
        FROM orders
        """,
    ),
    "src_delimited_rejected": (
        "",
        """
        SELECT CASE WHEN reason = 'read' THEN o_orderkey::VARCHAR ELSE o_orderkey || ';' || day || ';' ||
        amount || 'card' || o_custkey || ';' || type || ';SUCCESS;T1' END AS line, reason
        FROM (SELECT *, o_orderkey % 50 AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || CASE WHEN
        k = 1 THEN '?' ELSE '' END AS day, CASE WHEN k IN (1, 2) THEN 'many;' WHEN k = 5 THEN '' ELSE
        replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') || ';' END AS amount,
        CASE WHEN k = 3 THEN 'a;b;c;d' ELSE 'PAYMENT' END AS type, CASE WHEN k IN (3, 5) THEN 'width'
        WHEN k = 1 THEN 'transaction_date' WHEN k = 2 THEN 'amount' ELSE 'read' END AS reason
        FROM orders)
        """,
    ),
    "normalize_keys": (
        "",
        """
        SELECT trim('  ' || c_name || ' ') AS key
        FROM customer
        """,
    ),
    "parse_dates": (
        "",
        """
        SELECT o_orderkey, strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y') AS dt,
        strftime(o_orderdate, '%Y-%m-%d') AS iso
        FROM orders
        """,
    ),
    "change_time": (
        "acct_changes",
        """
        SELECT account_num, coalesce(update_dt, create_dt) AS change_ts
        FROM acct_changes
        """,
    ),
    "full_name": (
        "dim_clients",
        """
        SELECT client_id, coalesce(last_name,'') || ' ' || coalesce(first_name,'') || ' ' ||
        coalesce(patronymic,'') AS fio
        FROM dim_clients
        """,
    ),
    "watermark_extract": (
        "acct_changes",
        """
        SELECT account_num, status, coalesce(update_dt, create_dt) AS change_ts
        FROM acct_changes
        WHERE coalesce(update_dt, create_dt) > TIMESTAMP '2000-01-01 00:00:00'
        """,
    ),
    "watermark_advance": (
        "acct_changes",
        """
        SELECT 'accounts' AS tablename, greatest(TIMESTAMP '2000-01-01 00:00:00',
        max(coalesce(update_dt, create_dt))) AS last_update
        FROM acct_changes
        UNION ALL SELECT 'empty', greatest(TIMESTAMP '2000-01-01 00:00:00', max(o_orderdate))
        FROM orders
        WHERE o_orderkey < 0
        """,
    ),
    "snapshot_new": (
        "cust_v1 cust_v2",
        """
        SELECT b.*
        FROM cust_v2 b
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v1 a
        WHERE a.k = b.k)
        """,
    ),
    "snapshot_changed": (
        "cust_v1 cust_v2",
        """
        SELECT b.*
        FROM cust_v2 b
        JOIN cust_v1 a ON a.k = b.k
        WHERE a.nm IS DISTINCT
        FROM b.nm OR a.seg IS DISTINCT
        FROM b.seg OR a.nk IS DISTINCT
        FROM b.nk
        """,
    ),
    "snapshot_deleted": (
        "cust_v1 cust_v2",
        """
        SELECT a.*
        FROM cust_v1 a
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v2 b
        WHERE a.k = b.k)
        """,
    ),
    "scd2_insert_versions": (
        "cust_v1 cust_v2",
        """
        SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:00:00' AS effective_from, TIMESTAMP
        '2999-12-31 00:00:00' AS effective_to, 'N' AS deleted_flg
        FROM ((SELECT b.*
        FROM cust_v2 b
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v1 a
        WHERE a.k = b.k))
        UNION ALL (SELECT b.*
        FROM cust_v2 b
        JOIN cust_v1 a ON a.k = b.k
        WHERE a.nm IS DISTINCT
        FROM b.nm OR a.seg IS DISTINCT
        FROM b.seg OR a.nk IS DISTINCT
        FROM b.nk))
        """,
    ),
    "scd2_close_versions": (
        "cust_v1 cust_v2",
        """
        SELECT a.k, a.nm, a.seg, a.nk, TIMESTAMP '2021-03-01 00:00:00' AS effective_from, TIMESTAMP
        '2021-03-02 00:00:00' - INTERVAL 1 SECOND AS effective_to, 'N' AS deleted_flg
        FROM cust_v1 a
        WHERE a.k IN (SELECT k
        FROM (SELECT b.*
        FROM cust_v2 b
        JOIN cust_v1 a ON a.k = b.k
        WHERE a.nm IS DISTINCT
        FROM b.nm OR a.seg IS DISTINCT
        FROM b.seg OR a.nk IS DISTINCT
        FROM b.nk))
        """,
    ),
    "scd2_tombstones": (
        "cust_v1 cust_v2",
        """
        SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:45:00' AS effective_from, TIMESTAMP
        '2999-12-31 00:00:00' AS effective_to, 'Y' AS deleted_flg
        FROM (SELECT a.*
        FROM cust_v1 a
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v2 b
        WHERE a.k = b.k))
        """,
    ),
    "scd2_apply_snapshot": (
        "cust_v1 cust_v2",
        """
        SELECT a.k, a.nm, a.seg, a.nk, TIMESTAMP '2021-03-01 00:00:00' AS effective_from, CASE WHEN
        b.k IS NULL THEN TIMESTAMP '2021-03-02 00:45:00' - INTERVAL 1 SECOND WHEN a.nm IS DISTINCT
        FROM b.nm OR a.seg IS DISTINCT
        FROM b.seg OR a.nk IS DISTINCT
        FROM b.nk THEN TIMESTAMP '2021-03-02 00:00:00' - INTERVAL 1 SECOND ELSE TIMESTAMP
        '2999-12-31 00:00:00' END AS effective_to, 'N' AS deleted_flg
        FROM cust_v1 a
        LEFT JOIN cust_v2 b ON a.k = b.k
        UNION ALL SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:00:00' AS effective_from,
        TIMESTAMP '2999-12-31 00:00:00' AS effective_to, 'N' AS deleted_flg
        FROM ((SELECT b.*
        FROM cust_v2 b
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v1 a
        WHERE a.k = b.k))
        UNION ALL (SELECT b.*
        FROM cust_v2 b
        JOIN cust_v1 a ON a.k = b.k
        WHERE a.nm IS DISTINCT
        FROM b.nm OR a.seg IS DISTINCT
        FROM b.seg OR a.nk IS DISTINCT
        FROM b.nk))
        UNION ALL SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:45:00' AS effective_from,
        TIMESTAMP '2999-12-31 00:00:00' AS effective_to, 'Y' AS deleted_flg
        FROM (SELECT a.*
        FROM cust_v1 a
        WHERE NOT EXISTS (SELECT 1
        FROM cust_v2 b
        WHERE a.k = b.k))
        """,
    ),
    "scd2_apply_incremental": (
        "acct_changes",
        """
        SELECT account_num, status, effective_from, CASE WHEN nxt IS NULL AND account_num NOT IN
        (SELECT c_custkey
        FROM customer
        WHERE c_custkey % 13 <> 4) THEN TIMESTAMP '2002-01-01 00:45:00' - INTERVAL 1 SECOND ELSE
        coalesce(nxt, TIMESTAMP '2999-12-31 00:00:00') END AS effective_to, 'N' AS deleted_flg
        FROM (SELECT account_num, status, change_ts AS effective_from, lead(change_ts) OVER
        (PARTITION BY account_num ORDER BY change_ts) - INTERVAL 1 SECOND AS nxt
        FROM (SELECT account_num, coalesce(update_dt, create_dt) AS change_ts, max(status) AS status
        FROM acct_changes
        GROUP BY ALL))
        UNION ALL SELECT account_num, status, TIMESTAMP '2002-01-01 00:45:00', TIMESTAMP '2999-12-31
        00:00:00', 'Y'
        FROM (SELECT account_num, status, change_ts AS effective_from, lead(change_ts) OVER
        (PARTITION BY account_num ORDER BY change_ts) - INTERVAL 1 SECOND AS nxt
        FROM (SELECT account_num, coalesce(update_dt, create_dt) AS change_ts, max(status) AS status
        FROM acct_changes
        GROUP BY ALL))
        WHERE nxt IS NULL AND account_num NOT IN (SELECT c_custkey
        FROM customer
        WHERE c_custkey % 13 <> 4)
        """,
    ),
    "dim_current": (
        "dim_cards",
        """
        SELECT *
        FROM dim_cards
        WHERE effective_to = TIMESTAMP '2999-12-31 00:00:00'
        """,
    ),
    "dim_as_of": (
        "dim_cards",
        """
        SELECT *
        FROM dim_cards
        WHERE TIMESTAMP '2024-01-15 23:59:59' BETWEEN effective_from AND effective_to AND
        deleted_flg = 'N'
        """,
    ),
    "dim_first_seen": (
        "acct_changes",
        """
        SELECT account_num, change_ts, min(change_ts) OVER (PARTITION BY account_num ORDER BY
        change_ts) AS first_seen
        FROM (SELECT account_num, coalesce(update_dt, create_dt) AS change_ts, max(status) AS status
        FROM acct_changes
        GROUP BY ALL)
        """,
    ),
    "dim_first_seen_hot": (
        "",
        """
        SELECT l_orderkey, l_linenumber, flag, l_shipdate,
        min(l_shipdate) OVER (PARTITION BY flag) AS first_seen
        FROM (SELECT *, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag FROM lineitem)
        """,
    ),
    "fact_transactions_load": (
        "",
        """
        SELECT l_orderkey AS card_num, l_linenumber AS trans_id, l_shipdate AS trans_date,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amt
        FROM lineitem
        """,
    ),
    "fact_blacklist_load": (
        "fact_blacklist",
        """
        SELECT passport_num, entry_dt
        FROM fact_blacklist
        WHERE entry_dt > TIMESTAMP '2024-01-10 00:00:00'
        """,
    ),
    "txn_enriched": (
        "dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT trans_date, client_id, passport_num, valid_to
        FROM enriched
        """,
    ),
    "txn_enriched_event": (
        "dim_clients fact_tx acct_changes card_history account_history client_history at_event",
        """
        SELECT card_num, trans_date, account_num, client_id, passport_num, valid_to
        FROM at_event
        """,
    ),
    "txn_enriched_event_hot": (
        "acct_changes account_history",
        """
        SELECT account_num AS key, o_orderkey, valid_to
        FROM orders
        JOIN account_history ON o_custkey % 7 = account_num AND o_orderdate BETWEEN effective_from
        AND effective_to
        """,
    ),
    "fraud_report_event": (
        "dim_clients fact_blacklist fact_tx acct_changes card_history account_history client_history"
        " at_event",
        """
        , told AS (SELECT *, coalesce(last_name,'') || ' ' || coalesce(first_name,'') || ' ' ||
        coalesce(patronymic,'') AS fio
        FROM at_event), listed AS (SELECT substr(passport_num, 2) AS number, min(entry_dt) - INTERVAL
        9400 DAY AS entry_dt
        FROM fact_blacklist
        GROUP BY ALL)
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, fio, phone, '1' AS event_type,
        TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM told
        WHERE passport_valid_to < trans_date OR EXISTS (SELECT 1
        FROM listed
        WHERE number = substr(passport_num, 2) AND entry_dt <= trans_date)
        UNION ALL
        SELECT DISTINCT trans_date, passport_num, fio, phone, '2', TIMESTAMP '2024-01-15 23:59:59'
        FROM told
        WHERE valid_to < trans_date
        """,
    ),
    "fraud_passport_blacklisted": (
        "fact_blacklist dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') ||
        ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '1' AS
        event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE passport_num IN (SELECT passport_num
        FROM fact_blacklist
        WHERE entry_dt <= TIMESTAMP '2024-01-15 23:59:59')
        """,
    ),
    "fraud_passport_expired": (
        "dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') ||
        ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '1' AS
        event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE passport_valid_to < TIMESTAMP '2024-01-15 23:59:59'
        """,
    ),
    "fraud_report_passport": (
        "fact_blacklist dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') ||
        ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '1' AS
        event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE (passport_num IN (SELECT passport_num
        FROM fact_blacklist
        WHERE entry_dt <= TIMESTAMP '2024-01-15 23:59:59')) OR passport_valid_to < TIMESTAMP
        '2024-01-15 23:59:59'
        """,
    ),
    "fraud_passport_all_rows": (
        "fact_blacklist dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') || ' ' ||
        coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '1' AS event_type,
        TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE (passport_num IN (SELECT passport_num
        FROM fact_blacklist
        WHERE entry_dt <= TIMESTAMP '2024-01-15 23:59:59')) OR passport_valid_to < TIMESTAMP
        '2024-01-15 23:59:59'
        """,
    ),
    "fraud_report_contract": (
        "dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') ||
        ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '2' AS
        event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE valid_to < TIMESTAMP '2024-01-15 23:59:59'
        """,
    ),
    "fraud_report_all": (
        "fact_blacklist dim_cards dim_accounts dim_clients fact_tx enriched",
        """
        SELECT DISTINCT trans_date AS event_id, passport_num AS passport, coalesce(last_name,'') ||
        ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'') AS fio, phone, '1' AS
        event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE (passport_num IN (SELECT passport_num
        FROM fact_blacklist
        WHERE entry_dt <= TIMESTAMP '2024-01-15 23:59:59')) OR passport_valid_to < TIMESTAMP
        '2024-01-15 23:59:59'
        UNION ALL SELECT DISTINCT trans_date AS event_id, passport_num AS passport,
        coalesce(last_name,'') || ' ' || coalesce(first_name,'') || ' ' || coalesce(patronymic,'')
        AS fio, phone, '2' AS event_type, TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM enriched
        WHERE valid_to < TIMESTAMP '2024-01-15 23:59:59'
        """,
    ),
    "src_file_date": (
        "",
        """
        SELECT o_orderkey AS id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS file_date
        FROM orders
        """,
    ),
    "src_workbook": (
        "",
        """
        SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
        TIMESTAMP '2023-01-01 00:00:00' + to_days((c_custkey % 800)::INT) AS valid_to
        FROM customer
        """,
    ),
    "validate_history": (
        "",
        """
        , versions AS (
            SELECT o_custkey AS k, o_orderdate AS f,
            CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 DAY
            ELSE TIMESTAMP '2999-12-31 00:00:00' END AS t
            FROM orders
        ), starts AS (
            SELECT k, f, count(*) AS n, max(t) AS t FROM versions GROUP BY k, f
        ), chain AS (
            SELECT t, lead(f) OVER (PARTITION BY k ORDER BY f) AS nxt FROM starts
        ), keys AS (
            SELECT k, count(*) FILTER (WHERE t = TIMESTAMP '2999-12-31 00:00:00') AS n
            FROM versions GROUP BY k
        )
        SELECT 'open_rows' AS check_name, count(*) AS violations FROM keys WHERE n <> 1
        UNION ALL SELECT 'reversed', count(*) FROM versions WHERE f > t
        UNION ALL SELECT 'duplicate_start', count(*) FROM starts WHERE n > 1
        UNION ALL SELECT 'broken_chain', count(*) FROM chain WHERE t <> nxt - INTERVAL 1 SECOND
        """,
    ),
    "feed_stream": (
        "",
        """
        SELECT CAST(o_orderkey AS VARCHAR) AS trans_id, o_orderdate AS trans_date,
        CAST(o_custkey AS VARCHAR) AS card_num, o_orderpriority AS oper_type,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amt, o_orderstatus AS oper_result, 'T1' AS terminal
        FROM orders
        """,
    ),
    "terminals_load": (
        "cust_v1 cust_v2",
        """
        , both_days AS (
            SELECT a.k, a.nm, a.seg, a.nk, b.k AS k2,
            b.k IS NULL OR a.nm IS DISTINCT FROM b.nm OR a.seg IS DISTINCT FROM b.seg
            OR a.nk IS DISTINCT FROM b.nk AS ends
            FROM cust_v1 a LEFT JOIN cust_v2 b ON a.k = b.k
        ), versions AS (
            SELECT k, nm, seg, nk, TIMESTAMP '2021-03-01 00:00:00' AS f,
            CASE WHEN ends THEN TIMESTAMP '2021-03-01 23:59:59'
            ELSE TIMESTAMP '2999-12-31 00:00:00' END AS t, 'N' AS flg
            FROM both_days
            UNION ALL
            SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:00:00',
            TIMESTAMP '2999-12-31 00:00:00', 'Y'
            FROM both_days WHERE k2 IS NULL
            UNION ALL
            SELECT k, nm, seg, nk, TIMESTAMP '2021-03-02 00:00:00',
            TIMESTAMP '2999-12-31 00:00:00', 'N'
            FROM cust_v2 WHERE k NOT IN (SELECT k FROM both_days WHERE NOT ends)
        )
        SELECT CAST(k AS VARCHAR) AS terminal_id, seg AS terminal_type, nm AS terminal_city,
        CAST(nk AS VARCHAR) AS terminal_address, f AS effective_from, t AS effective_to,
        flg AS deleted_flg
        FROM versions
        """,
    ),
    "cards_load": (
        "",
        """
        , cards AS (
            SELECT CAST(o_orderkey AS VARCHAR) AS card_num,
            CAST(o_custkey AS VARCHAR) AS account_num, o_orderdate AS f,
            o_orderkey % 11 <> 5 AND o_orderkey % 3 = 0 AS moved,
            o_orderkey % 11 = 5 AS gone
            FROM orders
        )
        SELECT card_num, account_num, f AS effective_from,
        CASE WHEN moved THEN TIMESTAMP '2010-01-01 07:59:59'
        WHEN gone THEN TIMESTAMP '2010-01-01 23:59:59'
        ELSE TIMESTAMP '2999-12-31 00:00:00' END AS effective_to, 'N' AS deleted_flg
        FROM cards
        UNION ALL
        SELECT card_num, 'moved', TIMESTAMP '2010-01-01 08:00:00',
        TIMESTAMP '2999-12-31 00:00:00', 'N'
        FROM cards WHERE moved
        UNION ALL
        SELECT card_num, account_num, TIMESTAMP '2010-01-02 00:00:00',
        TIMESTAMP '2999-12-31 00:00:00', 'Y'
        FROM cards WHERE gone
        """,
    ),
    "report_stored": (
        "dim_clients dim_accounts fact_blacklist",
        """
        , used AS (
            SELECT DISTINCT l_shipdate AS event_id, passport_num, passport_valid_to, valid_to,
            coalesce(last_name,'') || ' ' || coalesce(first_name,'') || ' '
            || coalesce(patronymic,'') AS fio, phone
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN dim_accounts ON o_custkey = account_num
            JOIN dim_clients ON client = client_id
            WHERE l_shipdate <= TIMESTAMP '2024-01-15 23:59:59'
        )
        SELECT DISTINCT event_id, passport_num AS passport, fio, phone, '1' AS event_type,
        TIMESTAMP '2024-01-15 23:59:59' AS report_dt
        FROM used
        WHERE passport_valid_to < TIMESTAMP '2024-01-15 23:59:59' OR passport_num IN (
            SELECT passport_num FROM fact_blacklist
            WHERE entry_dt <= TIMESTAMP '2024-01-15 23:59:59')
        UNION ALL
        SELECT DISTINCT event_id, passport_num, fio, phone, '2',
        TIMESTAMP '2024-01-15 23:59:59'
        FROM used WHERE valid_to < TIMESTAMP '2024-01-15 23:59:59'
        """,
    ),
}


def oracle(name: str) -> str:
    needs, statement = STATEMENTS[name]
    wanted = needs.split()
    parts = [f"{n} AS ({RELATIONS[n].strip()})" for n in RELATIONS if n in wanted]
    statement = statement.strip()
    if statement.startswith(","):  # further relations of its own
        parts.append(statement.removeprefix(",").strip())
        return f"WITH {', '.join(parts)}"
    return f"WITH {', '.join(parts)} {statement}" if parts else statement


ORACLE = {name: oracle(name) for name in STATEMENTS}
