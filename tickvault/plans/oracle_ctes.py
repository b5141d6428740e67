"""DuckDB SQL for the same test-table mapping as ``tables`` - written independently as plain
SQL so the oracle does not share code with the Spark side."""

COINS = """coins AS (
  SELECT CAST(p_partkey AS VARCHAR) AS coin_id, p_name AS name,
         upper(regexp_extract(p_name, '([^ ]+)$', 1)) AS symbol, p_size AS rank,
         p_type = 'PROMO' AS is_new, p_retailprice >= 950.0 AS is_active, lower(p_type) AS type
  FROM part)"""

META = """meta AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS m_symbol, c_nationkey AS m_rank,
         c_acctbal < 0 AS is_new, c_mktsegment <> 'AUTOMOBILE' AS is_active,
         CASE WHEN c_nationkey < 12 THEN 'coin' ELSE 'token' END AS type,
         CASE WHEN c_acctbal > 5000 THEN NULL ELSE concat_ws(' / ', c_name, c_mktsegment) END AS description,
         CASE WHEN c_nationkey = 0 THEN NULL
              ELSE TIMESTAMP '2010-01-01 00:00:00' + to_hours(CAST(c_custkey AS BIGINT)) END AS started_at,
         CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE 'Working product' END AS development_status,
         c_acctbal > 8000 AS hardware_wallet,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Proof of Work'
              WHEN c_mktsegment = 'MACHINERY' THEN 'Proof of Stake' END AS proof_type,
         'Decentralized' AS org_structure,
         CASE WHEN c_nationkey % 2 = 0 THEN 'SHA256' END AS hash_algorithm
  FROM customer)"""

TICK = """last_order AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                 FROM orders) WHERE rn = 1),
order_stats AS (
  SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first_at, max(o_totalprice) AS vol FROM orders GROUP BY o_custkey),
tick AS (
  SELECT CAST(l.o_custkey AS VARCHAR) AS id,
         CASE WHEN l.o_orderpriority = '5-LOW' THEN NULL ELSE substr(l.o_orderpriority, 3, 100) END AS symbol,
         CAST(s.n AS INTEGER) AS rank, s.n * 1000 AS total_supply,
         CASE WHEN s.n > 10 THEN 0 ELSE s.n * 2000 END AS max_supply,
         CASE WHEN l.o_orderstatus = 'P' THEN '' ELSE strftime(l.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS last_updated_text,
         CASE WHEN l.o_orderstatus = 'P' THEN NULL ELSE l.o_orderdate END AS last_updated,
         l.o_totalprice AS price, s.vol AS volume_24h, l.o_totalprice * s.n AS market_cap
  FROM last_order l JOIN order_stats s ON l.o_custkey = s.o_custkey)"""

PRICES = """prices AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, ts AS read_timestamp,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, value AS price,
         value * CAST(json_extract(props, '$.k') AS BIGINT) AS volume_24h,
         CAST(json_extract(props, '$.k') AS DOUBLE) * 1000.0 AS market_cap,
         event_id, event_type, ts
  FROM events)"""

POSTS = """posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS submission_id, split_part(text, chr(10), 1) AS title,
         n_chars AS score, make_timestamp((1704067200 + doc_id * 3600) * 1000000) AS created_utc,
         source AS subreddit, lang, text
  FROM documents)"""

RAW_POSTS = """raw_posts AS (
  SELECT d.doc_id AS id,
         CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 0 THEN '' ELSE split_part(d.text, chr(10), 1) END AS title,
         d.n_chars AS score,
         'https://www.reddit.com/r/' || d.source || '/comments/' || CAST(d.doc_id AS VARCHAR) AS url,
         len(string_split(d.text, chr(10))) - 1 AS num_comments,
         1704067200 + d.doc_id * 3600 AS created_utc,
         CASE WHEN l.toxic = 1 THEN '' ELSE d.text END AS selftext,
         d.source AS subreddit,
         CASE WHEN d.lang = 'de' THEN NULL ELSE 'user_' || d.source END AS author,
         d.lang AS link_flair_text, d.lang, d.text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

HISTORY = """points AS (
  SELECT CAST(o_custkey AS VARCHAR) AS coin_id, o_orderdate AS read_timestamp, o_totalprice AS price,
         o_totalprice AS volume_24h, o_totalprice * 10 AS market_cap FROM orders
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate + INTERVAL 12 HOUR END,
         o_totalprice * CAST(1.01 AS DOUBLE), o_totalprice, o_totalprice * 10 FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
