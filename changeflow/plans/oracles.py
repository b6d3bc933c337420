"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

_EVENTS = """
ev AS (
  SELECT event_id AS n, epoch_us(ts) // 1000 AS ms, ts, user_id, event_type, value, props,
    CAST(user_id * 15 AS VARCHAR) AS account,
    CASE WHEN event_id % 3 = 0 THEN 'u' || CAST(event_id AS VARCHAR) ELSE '' END AS uuid_text
  FROM events),
ctl AS (
  SELECT *,
    CASE WHEN n % 97 = 0 THEN ''
         WHEN n % 89 = 0 THEN '*' || uuid_text
         ELSE CASE WHEN event_type = 'error' THEN CASE WHEN n % 2 = 0 THEN '~' ELSE '-' END
                   WHEN event_type = 'signup' THEN '+'
                   WHEN event_type = 'view' AND n % 5 = 0 THEN NULL
                   ELSE '=' END || uuid_text END AS control,
    CASE WHEN event_type <> 'click' THEN
      CASE WHEN n % 101 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END END AS f_value,
    json_extract_string(props, '$.k') AS f_k
  FROM ev)"""

_HASHES = (
    _EVENTS
    + """,
chg AS (
  SELECT n, ms,
    CASE WHEN n % 11 = 0 THEN 'expire'
         WHEN event_type = 'error' AND n % 4 = 0 THEN 'del'
         WHEN n % 2 = 0 THEN 'hmset' ELSE 'hset' END AS event,
    CASE WHEN n % 79 = 0 THEN 'orphan'
         WHEN n % 13 = 0 AND n % 17 = 0 THEN 'guest:' || CAST(user_id AS VARCHAR) || ':x'
         WHEN n % 13 = 0 THEN 'guest:' || CAST(user_id AS VARCHAR)
         ELSE 'user:' || account END AS key,
    CASE WHEN n % 83 = 0 THEN 'string' ELSE 'hash' END AS kind,
    event_type = 'error' AND n % 4 = 0 AS gone,
    event_type AS f_type, f_value, f_k, CAST(n AS VARCHAR) AS f_seq, control
  FROM ctl),
val AS (
  SELECT *, CASE WHEN gone THEN '~' ELSE coalesce(control, '=') END AS txt FROM chg),
chk AS (
  SELECT *, substr(txt, 1, 1) AS op, nullif(substr(txt, 2), '') AS uuid,
    nullif(split_part(key, ':', 2), '') AS pk,
    CASE WHEN NOT gone AND kind <> 'hash' THEN 'not a hash'
         WHEN txt = '' THEN 'no operation'
         WHEN substr(txt, 1, 1) NOT IN ('~', '-', '=', '+')
           THEN 'unknown operation ' || substr(txt, 1, 1) END AS op_error
  FROM val),
cap AS (
  SELECT *, 'customer' AS target,
    CASE WHEN error IS NOT NULL THEN 'reject' WHEN op IN ('=', '~') THEN 'replicate' ELSE 'local' END AS route,
    CAST(CAST(pk AS BIGINT) % 4 AS INTEGER) AS shard,
    CASE WHEN op = '=' THEN f_type END AS c_mktsegment,
    CASE WHEN op = '=' THEN TRY_CAST(f_value AS DOUBLE) END AS c_acctbal
  FROM (
    SELECT *, CASE WHEN op_error IS NOT NULL THEN op_error
                   WHEN op = '=' AND f_value IS NULL THEN 'missing field value'
                   WHEN op = '=' AND TRY_CAST(f_value AS DOUBLE) IS NULL THEN 'bad value for c_acctbal' END AS error
    FROM chk WHERE key LIKE 'user:%' AND event IN ('hset', 'hmset', 'del', 'change'))),
rep AS (SELECT * FROM cap WHERE route = 'replicate'),
tgt AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, c_acctbal FROM customer)"""
)

# Last record of each key in `rep`, and whether a delete came before it.
_NET = """,
net AS (
  SELECT pk, ms, n, op, c_mktsegment, c_acctbal, op = '=' AND any_delete AS reset
  FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY ms DESC, n DESC) AS rn,
          bool_or(op = '~') OVER (PARTITION BY pk) AS any_delete FROM {log})
  WHERE rn = 1),
merged AS (
  SELECT coalesce(tgt.c_custkey, net.pk) AS c_custkey,
    CASE WHEN net.reset THEN NULL ELSE c_name END AS c_name,
    CASE WHEN net.op IS NULL THEN tgt.c_mktsegment ELSE net.c_mktsegment END AS c_mktsegment,
    CASE WHEN net.op IS NULL THEN tgt.c_acctbal ELSE net.c_acctbal END AS c_acctbal
  FROM tgt FULL JOIN net ON tgt.c_custkey = net.pk
  WHERE net.op IS NULL OR net.op <> '~')"""

_SOURCE = """,
src AS (
  SELECT 'user:' || CAST(c_custkey AS VARCHAR) AS key, c_name AS f_name, c_mktsegment AS f_type,
    CAST(c_nationkey AS VARCHAR) AS f_k,
    CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS VARCHAR) END AS f_value
  FROM customer),
img AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ms DESC, n DESC) AS rn
    FROM cap WHERE gone OR kind = 'hash') WHERE rn = 1),
state AS (
  SELECT coalesce(src.key, img.key) AS key,
    CASE WHEN img.key IS NULL THEN src.f_name END AS f_name,
    CASE WHEN img.key IS NULL THEN src.f_type ELSE img.f_type END AS f_type,
    CASE WHEN img.key IS NULL THEN src.f_value ELSE img.f_value END AS f_value,
    CASE WHEN img.key IS NULL THEN src.f_k ELSE img.f_k END AS f_k,
    img.f_seq
  FROM src FULL JOIN img ON src.key = img.key
  WHERE img.key IS NULL OR img.op NOT IN ('~', '-'))"""

_WATERMARK = """,
wm AS (
  SELECT 'customer' AS target, shard, id.ms AS ms, id.n AS n FROM (
    SELECT CAST(CAST(account AS BIGINT) % 4 AS INTEGER) AS shard,
      max({'ms': ms, 'n': n}) AS id
    FROM ev WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1)
  WHERE shard <> 0),
fresh AS (
  SELECT rep.* FROM rep LEFT JOIN wm USING (shard)
  WHERE wm.ms IS NULL OR rep.ms > wm.ms OR (rep.ms = wm.ms AND rep.n > wm.n))"""

_ACKS = """,
acks AS (
  SELECT '{' || key || '}' || uuid AS ack_key, key, uuid, status, error, ack_ts,
    ack_ts + INTERVAL 3600 SECOND AS expires_at
  FROM (
    SELECT *, TIMESTAMP '1970-01-01' + to_microseconds(ms * 1000) AS ack_ts,
      CASE WHEN route = 'reject' THEN 'failed' ELSE 'done' END AS status
    FROM cap WHERE uuid IS NOT NULL))"""

_DOCUMENTS = (
    _EVENTS
    + """,
docs AS (
  SELECT n, ms, 'user:' || account AS key, account AS pk, doc,
    CASE WHEN n % 11 = 0 THEN 'json.get' WHEN doc IS NULL THEN 'json.del' ELSE 'json.set' END AS event
  FROM (
    SELECT *, CASE
      WHEN event_type = 'error' AND n % 2 = 0 THEN NULL
      WHEN n % 59 = 0 THEN 'not json'
      WHEN n % 61 = 0 THEN '[1,2]'
      WHEN n % 53 = 0 THEN '{}'
      ELSE '{"type":"' || event_type || '","props":' || props
        || CASE WHEN event_type <> 'click' THEN ',"cents":' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) ELSE '' END
        || CASE WHEN n % 7 = 0 THEN ',"note":"it''s"' WHEN n % 5 = 0 THEN ',"note":null' ELSE '' END
        || '}' END AS doc
    FROM ev)),
dcap AS (
  SELECT *, CASE WHEN doc IS NULL THEN '~' ELSE '=' END AS op,
    CASE WHEN doc IN ('not json', '[1,2]') THEN 'not a JSON object' END AS error
  FROM docs WHERE event <> 'json.get'),
dgood AS (SELECT * FROM dcap WHERE error IS NULL),
dlast AS (
  SELECT pk, max(n) FILTER (op = '~') AS deleted_at, max(n) AS seen_at FROM dgood GROUP BY pk),
dfield AS (
  SELECT pk, n, unnest(json_keys(doc)) AS field, doc FROM dgood WHERE op = '='),
dnew AS (
  SELECT pk, field, CAST(json_extract(doc, '$."' || field || '"') AS VARCHAR) AS value FROM (
    SELECT *, row_number() OVER (PARTITION BY pk, field ORDER BY n DESC) AS rn
    FROM dfield JOIN dlast USING (pk) WHERE deleted_at IS NULL OR n > deleted_at)
  WHERE rn = 1),
dold AS (
  SELECT CAST(c_custkey AS VARCHAR) AS pk, unnest(['name', 'type']) AS field,
    unnest(['"' || c_name || '"', '"' || c_mktsegment || '"']) AS value
  FROM customer),
dmerged AS (
  SELECT pk, field, value FROM dnew
  UNION ALL
  SELECT pk, field, value FROM dold
  WHERE NOT EXISTS (SELECT 1 FROM dnew WHERE dnew.pk = dold.pk AND dnew.field = dold.field)
    AND NOT EXISTS (SELECT 1 FROM dlast WHERE dlast.pk = dold.pk AND deleted_at IS NOT NULL))"""
)

# Documents without any field show as one row with a null field.
_DOCUMENT_ROWS = """
SELECT pk, field, value FROM dmerged
UNION ALL
SELECT pk, NULL, NULL FROM dlast
WHERE (deleted_at IS NULL OR seen_at > deleted_at) AND pk NOT IN (SELECT pk FROM dmerged)"""

# Write-through: the after-image of a staged write needs the writes before it that succeeded.
# No local write of the views has an unfit value, so a field is open only since the last delete
# (or since the start), and any success after that closes it.
_STAGED = (
    _EVENTS
    + """,
stg AS (
  SELECT n, ms, CASE WHEN n % 79 = 0 THEN NULL ELSE 'user:' || account END AS key,
    CASE WHEN n % 79 = 0 THEN NULL ELSE account END AS pk,
    event_type AS f_type, CAST(n AS VARCHAR) AS f_seq, f_k,
    f_value,
    coalesce(control, '=') AS txt
  FROM ctl WHERE n % 11 <> 0),
sval AS (
  SELECT *, substr(txt, 1, 1) AS op, nullif(substr(txt, 2), '') AS uuid,
    CASE WHEN key IS NULL THEN 'no real key in the staging key'
         WHEN txt = '' THEN 'no operation'
         WHEN substr(txt, 1, 1) NOT IN ('~', '-', '=', '+')
           THEN 'unknown operation ' || substr(txt, 1, 1) END AS op_error
  FROM stg),
ssrc AS (
  SELECT 'user:' || CAST(c_custkey AS VARCHAR) AS key, c_name AS f_name, c_mktsegment AS b_type,
    CAST(c_nationkey AS VARCHAR) AS b_k,
    CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS VARCHAR) END AS b_value
  FROM customer),
snum AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n) AS i FROM sval WHERE key IS NOT NULL),
sreplay AS (
  SELECT key, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS n, b_value AS i_value, b_value AS held, false AS ok
  FROM (SELECT DISTINCT key FROM snum) LEFT JOIN ssrc USING (key)
  UNION ALL
  SELECT key, i, n, over, CASE WHEN op_error IS NULL AND op IN ('~', '-') THEN NULL
    WHEN ok OR (op_error IS NULL AND op = '+') THEN over ELSE held END, ok
  FROM (
    SELECT s.key, s.i, s.n, s.op, s.op_error, r.held, coalesce(s.f_value, r.held) AS over,
      s.op_error IS NULL AND s.op = '=' AND TRY_CAST(coalesce(s.f_value, r.held) AS DOUBLE) IS NOT NULL AS ok
    FROM sreplay r JOIN snum s ON s.key = r.key AND s.i = r.i + 1)),
simg AS (
  SELECT sval.*, coalesce(ok, false) AS ok, i_value FROM sval LEFT JOIN (SELECT n, ok, i_value FROM sreplay) USING (n)),
decided AS (
  SELECT *, CASE WHEN op_error IS NOT NULL THEN op_error
      WHEN op = '=' AND NOT ok AND i_value IS NULL THEN 'missing field value'
      WHEN op = '=' AND NOT ok THEN 'bad value for c_acctbal' END AS error,
    CASE WHEN ok THEN f_type END AS c_mktsegment,
    CASE WHEN ok THEN TRY_CAST(i_value AS DOUBLE) END AS c_acctbal,
    CASE WHEN ok THEN CAST(f_k AS INTEGER) END AS c_k
  FROM simg),
snet AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pk ORDER BY n DESC) AS rn,
      bool_or(op = '~') OVER (PARTITION BY pk) AS any_delete
    FROM decided WHERE error IS NULL AND op IN ('=', '~')) WHERE rn = 1),
starget AS (
  SELECT coalesce(CAST(c.c_custkey AS VARCHAR), snet.pk) AS c_custkey,
    CASE WHEN any_delete AND op = '=' THEN NULL ELSE c_name END AS c_name,
    CASE WHEN op IS NULL THEN c.c_mktsegment ELSE snet.c_mktsegment END AS c_mktsegment,
    CASE WHEN op IS NULL THEN c.c_acctbal ELSE snet.c_acctbal END AS c_acctbal,
    snet.c_k
  FROM customer c FULL JOIN snet ON CAST(c.c_custkey AS VARCHAR) = snet.pk
  WHERE op IS NULL OR op <> '~')"""
)


def _through_source(writes: str) -> str:
    """Source hashes after field-wise writes and deletes, one row per key."""
    return f""",
w AS (SELECT * FROM decided WHERE {writes}),
wd AS (
  SELECT key, max(n) FILTER (op IN ('~', '-')) AS deleted_at, max(n) AS seen_at FROM w GROUP BY key),
wf AS (
  SELECT w.key,
    arg_max(f_type, n) AS f_type, arg_max(f_k, n) AS f_k, arg_max(f_seq, n) AS f_seq,
    arg_max(f_value, n) FILTER (f_value IS NOT NULL) AS f_value
  FROM w JOIN wd USING (key)
  WHERE op IN ('=', '+') AND (deleted_at IS NULL OR n > deleted_at) GROUP BY w.key)
SELECT coalesce(ssrc.key, wd.key) AS key,
  CASE WHEN deleted_at IS NULL THEN f_name END AS f_name,
  coalesce(wf.f_type, CASE WHEN deleted_at IS NULL THEN b_type END) AS f_type,
  coalesce(wf.f_value, CASE WHEN deleted_at IS NULL THEN b_value END) AS f_value,
  coalesce(wf.f_k, CASE WHEN deleted_at IS NULL THEN b_k END) AS f_k,
  wf.f_seq
FROM ssrc FULL JOIN wd ON ssrc.key = wd.key LEFT JOIN wf ON wf.key = wd.key
WHERE deleted_at IS NULL OR seen_at > deleted_at"""


def _hashes(body: str, *parts: str) -> str:
    return "WITH " + _HASHES + "".join(parts) + body


def _net(log: str = "rep") -> str:
    return _NET.replace("{log}", log)


_MERGED = "\nSELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM merged"
_LOG_COLUMNS = "target, shard, ms, n, key, pk, op, uuid, c_mktsegment, c_acctbal"
_BATCHED = """,
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY ms, n) - 1) // 100 AS batch_no FROM rep)"""


def oracle_sql() -> dict[str, str]:
    merge = _hashes(_MERGED, _net())
    documents = "WITH " + _DOCUMENTS + _DOCUMENT_ROWS
    users = "key LIKE 'user:%'"
    copies = _hashes(
            """
, plain AS (SELECT * FROM cap WHERE op_error IS NULL AND op = '=')
SELECT 'copy:' || pk AS key, arg_max(f_type, n) AS f_type, arg_max(f_k, n) AS f_k,
  arg_max(f_value, n) FILTER (f_value IS NOT NULL) AS f_value
FROM plain GROUP BY pk"""
        )
    twins = {
        "a1_hash_changes": _hashes(
            "\nSELECT n, ms, event, key, kind, CASE WHEN NOT gone THEN f_type END AS f_type, "
            "CASE WHEN NOT gone THEN f_value END AS f_value, CASE WHEN NOT gone THEN f_k END AS f_k, "
            "CASE WHEN NOT gone THEN control END AS control FROM chg"
        ),
        "a2_json_changes": "WITH "
        + _DOCUMENTS
        + "\nSELECT n, ms, key, doc, CASE WHEN doc IS NULL THEN '~' ELSE '=' END AS op FROM docs",
        "a3_log_scan": _hashes(f"\nSELECT {_LOG_COLUMNS} FROM fresh", _WATERMARK),
        "b1_prefix_filter": _hashes(
            "\nSELECT n, key, key LIKE 'user:%' AS behind, key LIKE 'user%' AS through FROM chg "
            "WHERE key LIKE 'user%'"
        ),
        "b2_event_filter": _hashes(
            "\nSELECT n, event, key FROM chg WHERE event IN ('hset', 'hmset', 'del', 'change')"
        ),
        "b3_transform": _hashes(
            "\nSELECT n, upper(c_mktsegment) AS c_mktsegment, c_acctbal FROM cap WHERE route = 'replicate'"
        ),
        "b4_pk_extract": _hashes(
            "\nSELECT n, key, nullif(split_part(key, ':', 2), '') AS pk FROM chg"
        ),
        "b5_real_key": "WITH RECURSIVE "
        + _STAGED
        + "\nSELECT n, key FROM stg UNION ALL SELECT n, NULL FROM ctl WHERE false",
        "b6_validate_hash": _hashes("\nSELECT n, key, op, uuid, op_error AS error FROM chk"),
        "b7_validate_json": "WITH "
        + _DOCUMENTS
        + "\nSELECT n, CASE WHEN doc IS NULL THEN '~' ELSE '=' END AS op, CAST(NULL AS VARCHAR) AS uuid, "
        "CASE WHEN doc IN ('not json', '[1,2]') THEN 'not a JSON object' END AS error FROM docs",
        "b8_split_op": _hashes("\nSELECT n, txt AS control, op, uuid FROM chk"),
        "b9_route": _hashes("\nSELECT n, op, route FROM cap"),
        "b10_map_fields": _hashes(
            "\nSELECT n, pk, c_mktsegment, c_acctbal FROM cap WHERE route = 'replicate'"
        ),
        "b11_missing_fields": _hashes(
            "\nSELECT n, key, CASE WHEN f_value IS NULL THEN 'value' END AS missing FROM chk "
            f"WHERE {users} AND NOT gone AND op = '=' AND op_error IS NULL"
        ),
        "b12_typed_cast": _hashes(
            "\nSELECT n, TRY_CAST(f_value AS DOUBLE) AS c_acctbal, "
            "CASE WHEN f_value IS NOT NULL AND TRY_CAST(f_value AS DOUBLE) IS NULL THEN 'c_acctbal' END AS unfit "
            f"FROM chk WHERE {users} AND NOT gone"
        ),
        "b13_strip_reserved": _hashes(
            "\nSELECT n, 'type' AS name, f_type AS value FROM chg WHERE NOT gone "
            "UNION ALL SELECT n, 'value', f_value FROM chg WHERE NOT gone AND f_value IS NOT NULL "
            "UNION ALL SELECT n, 'k', f_k FROM chg WHERE NOT gone"
        ),
        "b14_log_id_order": "WITH "
        + _EVENTS
        + """,
ids AS (SELECT user_id, max({'ms': ms, 'n': n}) AS last FROM ev GROUP BY user_id)
SELECT ev.n, CASE WHEN ev.ms < last.ms OR (ev.ms = last.ms AND ev.n < last.n) THEN -1
  WHEN ev.ms = last.ms AND ev.n = last.n THEN 0 ELSE 1 END AS compared
FROM ev JOIN ids USING (user_id)""",
        "b15_append_log": _hashes(f"\nSELECT {_LOG_COLUMNS} FROM rep"),
        "b16_assign_shard": _hashes("\nSELECT pk, shard, count(*) AS records FROM rep GROUP BY ALL"),
        "b17_dead_letter": _hashes(
            "\nSELECT target, ms, n, key, uuid, error, CASE WHEN NOT gone THEN f_type END AS f_type, "
            "CASE WHEN NOT gone THEN f_value END AS f_value FROM cap WHERE route = 'reject'"
        ),
        "c1_batches": _hashes("\nSELECT shard, n, batch_no FROM numbered", _BATCHED),
        "c2_batch_gather": _hashes(
            "\nSELECT shard, batch_no, string_agg(pk, ',' ORDER BY pk) AS keys "
            "FROM (SELECT DISTINCT shard, batch_no, pk FROM numbered) GROUP BY ALL",
            _BATCHED,
        ),
        "c3_batch_count": _hashes(
            "\nSELECT shard, batch_no, count(*) AS records FROM numbered GROUP BY ALL", _BATCHED
        ),
        "c4_op_runs": _hashes(
            """
SELECT shard, run_no, op, count(*) AS records, min(n) AS first_n, max(n) AS last_n,
  min(ms) AS first_ms, max(ms) AS last_ms
FROM (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY shard ORDER BY ms, n) AS BIGINT) AS run_no FROM (
    SELECT *, CASE WHEN lag(op) OVER (PARTITION BY shard ORDER BY ms, n) IS NOT DISTINCT FROM op
      THEN 0 ELSE 1 END AS starts FROM rep))
GROUP BY shard, run_no, op"""
        ),
        "c5_net_change": _hashes(
            "\nSELECT pk, ms, n, op, reset, c_mktsegment, c_acctbal FROM net", _net()
        ),
        "d1_delete": _hashes(
            "\nSELECT * FROM tgt WHERE c_custkey NOT IN (SELECT pk FROM net WHERE op = '~')", _net()
        ),
        "d2_upsert_merge": merge,
        "d2_upsert_merge_small": merge,
        "d3_upsert_replace": _hashes(
            "\nSELECT * FROM tgt WHERE c_custkey NOT IN (SELECT pk FROM net) "
            "UNION ALL SELECT pk, NULL, c_mktsegment, c_acctbal FROM net WHERE op = '='",
            _net(),
        ),
        "d4_doc_merge": documents,
        "d5_json_flatten": "WITH "
        + _DOCUMENTS
        + """
SELECT n, field, CAST(json_extract(doc, '$."' || field || '"') AS VARCHAR) AS value FROM dfield
UNION ALL SELECT n, 'user_id', pk FROM dgood WHERE op = '='
UNION ALL SELECT n, 'event', '"' || event || '"' FROM dgood WHERE op = '='""",
        "d6_hash_merge": _hashes(
            """
SELECT 'mirror:' || coalesce(src_pk, net.pk) AS key,
  CASE WHEN net.reset THEN NULL ELSE f_name END AS f_name,
  CASE WHEN net.op IS NULL THEN h_type ELSE net.c_mktsegment END AS c_mktsegment,
  CASE WHEN net.op IS NULL THEN h_value ELSE CAST(net.c_acctbal AS VARCHAR) END AS c_acctbal
FROM (SELECT CAST(c_custkey AS VARCHAR) AS src_pk, c_name AS f_name, c_mktsegment AS h_type,
        CAST(c_acctbal AS VARCHAR) AS h_value FROM customer)
FULL JOIN net ON src_pk = net.pk WHERE net.op IS NULL OR net.op <> '~'""",
            _net(),
        ),
        "d7_hash_copy": copies,
        "d8_source_state": _hashes(
            "\nSELECT key, f_name, f_type, f_value, f_k, f_seq FROM state", _SOURCE
        ),
        "d9_drift": _hashes(
            """
, s AS (SELECT split_part(key, ':', 2) AS pk, f_type, TRY_CAST(f_value AS DOUBLE) AS v FROM state)
SELECT coalesce(pk, c_custkey) AS c_custkey,
  CASE WHEN c_custkey IS NULL THEN 'source only' WHEN pk IS NULL THEN 'target only' ELSE 'different' END AS state
FROM s FULL JOIN merged ON pk = c_custkey
WHERE pk IS NULL OR c_custkey IS NULL OR f_type IS DISTINCT FROM c_mktsegment OR v IS DISTINCT FROM c_acctbal""",
            _SOURCE,
            _net(),
        ),
        "e1_exactly_once": _hashes(_MERGED, _WATERMARK, _net("fresh")),
        "e2_watermark": _hashes(
            """
SELECT 'customer' AS target, shard, id.ms AS ms, id.n AS n FROM (
  SELECT shard, max({'ms': ms, 'n': n}) AS id FROM (
    SELECT shard, ms, n FROM wm UNION ALL SELECT shard, ms, n FROM rep) GROUP BY shard)""",
            _WATERMARK,
        ),
        "e3_atomic_commit": merge,
        "e4_replay_idempotent": merge,
        "e5_acks_done": _hashes(
            "\nSELECT acks.* FROM acks JOIN rep USING (key, uuid)", _ACKS
        ),
        "e6_acks_norepl": _hashes(
            "\nSELECT acks.* FROM acks JOIN cap USING (key, uuid) WHERE route = 'local'", _ACKS
        ),
        "e7_ack_status": _hashes(
            """
, asked AS (
  SELECT n, key, 'u' || CAST(n AS VARCHAR) AS uuid FROM chg WHERE n % 2 = 1 AND key LIKE 'user:%')
SELECT n, asked.key, asked.uuid,
  CASE WHEN status IS NULL THEN 'pending' WHEN expires_at > TIMESTAMP '2024-01-20' THEN status ELSE 'expired' END AS status,
  CASE WHEN expires_at > TIMESTAMP '2024-01-20' THEN error END AS error
FROM asked LEFT JOIN acks ON acks.key = asked.key AND acks.uuid = asked.uuid""",
            _ACKS,
        ),
        "e8_acks_failed": _hashes("\nSELECT * FROM acks WHERE status = 'failed'", _ACKS),
        "f1_overlay": "WITH RECURSIVE "
        + _STAGED
        + """
SELECT sval.n, key, f_name, f_type, coalesce(f_value, b_value) AS f_value, f_k, f_seq
FROM sval LEFT JOIN ssrc USING (key)""",
        "f2_through_norepl": "WITH RECURSIVE "
        + _STAGED
        + _through_source("error IS NULL AND op IN ('+', '-')"),
        "f3_gated_commit": "WITH RECURSIVE "
        + _STAGED
        + "\nSELECT n, key, op, uuid, error IS NULL AS done, error, c_mktsegment, c_acctbal, c_k FROM decided",
        "f3_source": "WITH RECURSIVE " + _STAGED + _through_source("error IS NULL"),
        "f4_json_through": documents,
        "g1_write_behind_stream": merge,
        "g1_acks": _hashes(
            "\nSELECT ack_key, key, uuid, status, error FROM acks WHERE status = 'done'", _ACKS
        ),
        "e1_late_records": _hashes(
            _MERGED, _net().replace("ORDER BY ms DESC", "ORDER BY n % 2 DESC, ms DESC")
        ),
        "e1_clock_back": _hashes(
            _MERGED, _net().replace("ORDER BY ms DESC", "ORDER BY n % 2 DESC, ms DESC")
        ),
        "g2_json_behind_stream": documents,
        "g3_write_through": "WITH RECURSIVE "
        + _STAGED
        + "\nSELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_k FROM starget",
        "g4_fan_out": _hashes(
            """
, gcap AS (
  SELECT *, row_number() OVER (PARTITION BY pk ORDER BY ms DESC, n DESC) AS rn FROM chk
  WHERE key LIKE 'guest:%' AND event IN ('hset', 'hmset', 'del', 'change') AND op_error IS NULL AND op IN ('=', '~'))
SELECT 'customer' AS target, c_custkey AS pk, c_name, c_mktsegment, c_acctbal,
  CAST(NULL AS VARCHAR) AS last_type, CAST(NULL AS INTEGER) AS last_k FROM merged
UNION ALL SELECT 'guests', pk, NULL, NULL, NULL, f_type, CAST(f_k AS INTEGER) FROM gcap WHERE rn = 1 AND op = '='""",
            _net(),
        ),
        "g4_rejects": _hashes(
            """
SELECT target, n, key, uuid, error FROM cap WHERE route = 'reject'
UNION ALL
SELECT 'guests', n, key, uuid, error FROM (
  SELECT *, coalesce(op_error,
    CASE WHEN op = '=' AND f_k IS NULL THEN 'missing field k'
         WHEN op = '=' AND TRY_CAST(f_k AS INTEGER) IS NULL THEN 'bad value for last_k' END) AS error
  FROM chk WHERE key LIKE 'guest:%' AND event IN ('hset', 'hmset', 'del', 'change'))
WHERE error IS NOT NULL"""
        ),
        "g3_source": "WITH RECURSIVE " + _STAGED + _through_source("error IS NULL"),
        "g3_acks": "WITH RECURSIVE "
        + _STAGED
        + """
SELECT '{' || key || '}' || uuid AS ack_key, key, uuid,
  CASE WHEN error IS NULL THEN 'done' ELSE 'failed' END AS status, error
FROM decided WHERE uuid IS NOT NULL""",
        "g3_repeat": "WITH RECURSIVE "
        + _STAGED
        + _through_source("error IS NULL").replace("\nSELECT coalesce(ssrc.key", ",\nsource_rows AS (SELECT coalesce(ssrc.key", 1)
        + """)
SELECT coalesce(s.key, 'user:' || t.c_custkey) AS key, s.f_type, s.f_value, s.f_seq, t.c_name, t.c_mktsegment, t.c_acctbal, t.c_k
FROM source_rows s FULL JOIN starget t ON s.key = 'user:' || t.c_custkey""",
        "h12_hash_copy": copies,
        "h13_versioned_table": merge,
    }
    # The same results by other paths.
    for name, path in (
        ("c1_batches", "c1_batches_hot_shards"),
        ("c4_op_runs", "c4_op_runs_hot_shards"),
        ("e3_atomic_commit", "e3_default_shards"),
        ("f3_gated_commit", "f3_gated_commit_hot_keys"),
    ):
        twins[path] = twins[name]
    return twins
