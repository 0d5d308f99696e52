"""DuckDB twins of the registered queries (same column names and types).

The models (`hashing_tfidf`, `svm_*`, `nb_accuracy`, `score_new`) have no SQL
twin; they are checked by row count here and
by tests against brute-force computations.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see spindle.plans.queries / derived).
_WS = "[ \\t\\n\\x0B\\f\\r]"
_LINE_BREAK = "\\r\\n|\\r|\\n"
_TS = "%Y-%m-%d %H:%M:%S.%f"


def _lines(text: str) -> str:
    return (f"CASE WHEN {text} IS NULL OR {text} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array(regexp_replace({text}, '({_LINE_BREAK})$', ''), '{_LINE_BREAK}') END")


def _jsplit(s: str, delim_sql: str) -> str:
    """Java-style split on a single literal character."""
    return (f"CASE WHEN {s} <> '' AND rtrim({s}, {delim_sql}) = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({s}, {delim_sql}), {delim_sql}) END")


def _tokens(text: str) -> str:
    low = f"lower({text})"
    stripped = f"regexp_replace({low}, '{_WS}+$', '')"
    return (f"CASE WHEN {low} <> '' AND {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({stripped}, '{_WS}') END")


_ONE_LINE = f"regexp_replace(text, '{_LINE_BREAK}', ' ', 'g')"

_SPLIT = "(((doc_id % 1000003) * 7919 + 11) % 1000003) % 100 < 60"

_LABELLED = """SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label, d.text AS sentence
               FROM documents d JOIN labels l USING (doc_id)"""

_WORDS = f"""
WITH lines AS (SELECT unnest({_lines('text')}) AS line FROM documents),
words AS (SELECT unnest({_jsplit('line', "' '")}) AS word FROM lines)
SELECT word, count(*) AS n FROM words GROUP BY word"""

_SENSOR = """
WITH r AS (
  SELECT user_id AS session_id, ts, event_id, event_type = 'error' AS is_marker,
         date_trunc('hour', ts) AS batch,
         CASE WHEN event_type = 'error' THEN -1 ELSE CAST(trunc(value) AS INTEGER) END AS heart_rate,
         CASE WHEN event_type = 'error' THEN -1 ELSE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS calorie
  FROM events)"""

_SENSOR_BATCHES = _SENSOR + """,
per AS (SELECT session_id, batch, sum(heart_rate) AS hr, sum(calorie) AS cal, count(*) AS n
        FROM r GROUP BY session_id, batch),
flag AS (SELECT *, (hr = -1 AND cal = -1) AS is_reset,
                sum(CASE WHEN hr = -1 AND cal = -1 THEN 1 ELSE 0 END)
                  OVER (PARTITION BY session_id ORDER BY batch ROWS UNBOUNDED PRECEDING) AS epoch
         FROM per)"""

_TWEETS = f"""SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset", ts AS "timestamp",
       CAST(event_id AS VARCHAR) AS id_str, strftime(ts, '{_TS}') AS created_at, event_type AS text,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

_CSV_A = f"""SELECT d.doc_id, '"' || CAST(l.quality * 4 AS VARCHAR) || '","' || CAST(d.doc_id AS VARCHAR) || '","'
       || d.lang || '","' || d.source || '","u","' || replace({_ONE_LINE.replace('text', 'd.text')}, '"', '""') || '"' AS line,
       l.quality, {_ONE_LINE.replace('text', 'd.text')} AS one_line
FROM documents d JOIN labels l USING (doc_id)"""

_TF = f"""WITH toks AS (SELECT doc_id, unnest({_tokens('text')}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
idf AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tf GROUP BY term)"""

ORACLE_SQL: dict[str, str] = {
    "word_count": _WORDS,
    "word_count_top": f"SELECT * FROM ({_WORDS}) ORDER BY n DESC, word ASC LIMIT 10",
    "word_count_sorted": f"SELECT n, word, row_number() OVER (ORDER BY n DESC, word ASC) AS rank FROM ({_WORDS})",
    "word_count_running": """
WITH per AS (SELECT event_type AS word, date_trunc('day', ts) AS batch, count(*) AS n FROM events GROUP BY 1, 2)
SELECT word, batch, n AS batch_n,
       CAST(sum(n) OVER (PARTITION BY word ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n
FROM per""",
    "sensor_running_avg": _SENSOR_BATCHES + """,
st AS (SELECT session_id, batch,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE hr END) OVER w AS BIGINT) AS total_hr,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE cal END) OVER w AS BIGINT) AS total_cal,
         CAST(sum(CASE WHEN is_reset THEN 1 ELSE n END) OVER w AS BIGINT) AS total_n
       FROM flag WINDOW w AS (PARTITION BY session_id, epoch ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT session_id, batch, total_hr, total_cal, total_n,
       CASE WHEN total_n <> 0 THEN total_hr // total_n END AS avg_hr,
       CASE WHEN total_n <> 0 THEN total_cal // total_n END AS avg_cal
FROM st""",
    "sensor_state_snapshot": _SENSOR_BATCHES + """,
st AS (SELECT session_id, batch,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE hr END) OVER w AS BIGINT) AS total_hr,
         CAST(sum(CASE WHEN is_reset THEN 0 ELSE cal END) OVER w AS BIGINT) AS total_cal,
         CAST(sum(CASE WHEN is_reset THEN 1 ELSE n END) OVER w AS BIGINT) AS total_n
       FROM flag WINDOW w AS (PARTITION BY session_id, epoch ORDER BY batch ROWS UNBOUNDED PRECEDING)),
last AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY batch DESC) AS rn FROM st)
SELECT session_id, batch, total_hr, total_cal, total_n,
       CASE WHEN total_n <> 0 THEN total_hr // total_n END AS avg_hr,
       CASE WHEN total_n <> 0 THEN total_cal // total_n END AS avg_cal
FROM last WHERE rn = 1""",
    "track_running_totals": _SENSOR_BATCHES + """
SELECT session_id, batch,
       CAST(sum(CASE WHEN is_reset THEN 0 ELSE hr END) OVER w AS BIGINT) AS total_hr,
       CAST(sum(CASE WHEN is_reset THEN 0 ELSE cal END) OVER w AS BIGINT) AS total_cal
FROM flag WINDOW w AS (PARTITION BY session_id, epoch ORDER BY batch ROWS UNBOUNDED PRECEDING)""",
    "session_marker_totals": _SENSOR + """,
s AS (SELECT *, sum(CASE WHEN is_marker THEN 1 ELSE 0 END)
                  OVER (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
                - CASE WHEN is_marker THEN 1 ELSE 0 END AS session_no FROM r),
g AS (SELECT session_id, CAST(session_no AS BIGINT) AS session_no,
             CAST(sum(CASE WHEN NOT is_marker THEN 1 ELSE 0 END) AS BIGINT) AS n,
             CAST(sum(CASE WHEN NOT is_marker THEN heart_rate ELSE 0 END) AS BIGINT) AS total_hr,
             CAST(sum(CASE WHEN NOT is_marker THEN calorie ELSE 0 END) AS BIGINT) AS total_cal,
             bool_or(is_marker) AS closed
      FROM s GROUP BY session_id, session_no)
SELECT session_id, session_no, n, total_hr, total_cal,
       CASE WHEN n <> 0 THEN total_hr // n END AS avg_hr,
       CASE WHEN n <> 0 THEN total_cal // n END AS avg_cal, closed
FROM g""",
    "sliding_count": """
WITH b AS (SELECT event_type, time_bucket(INTERVAL '60 seconds', ts) AS bucket, count(*) AS n
           FROM events GROUP BY 1, 2),
w AS (SELECT event_type, n,
             unnest(generate_series(bucket - INTERVAL '240 seconds', bucket, INTERVAL '60 seconds')) AS window_start
      FROM b)
SELECT window_start, window_start + INTERVAL '300 seconds' AS window_end, event_type, CAST(sum(n) AS BIGINT) AS n
FROM w GROUP BY window_start, event_type""",
    "sliding_count_1s": """
WITH b AS (SELECT event_type, time_bucket(INTERVAL '1 second', ts) AS bucket, count(*) AS n FROM events GROUP BY 1, 2),
w AS (SELECT event_type, n, unnest(generate_series(bucket - INTERVAL '299 seconds', bucket, INTERVAL '1 second')) AS window_start FROM b)
SELECT window_start, window_start + INTERVAL '300 seconds' AS window_end, event_type, CAST(sum(n) AS BIGINT) AS n
FROM w GROUP BY window_start, event_type""",
    "json_project": f"SELECT id_str, created_at, text, k FROM ({_TWEETS})",
    "keyed_upsert_latest": f"""
SELECT key AS row_key, 'twt' AS family, 'createdat' AS qualifier, created_at AS value
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "timestamp" DESC, "offset" DESC) AS rn
      FROM ({_TWEETS})) WHERE rn = 1""",
    "kafka_offset_ranges": """
SELECT date_trunc('hour', ts) AS batch, 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
       min(event_id) AS from_offset, max(event_id) + 1 AS until_offset, count(*) AS n_records
FROM events GROUP BY 1, 2, 3""",
    "csv_label_naive": f"""
WITH l AS ({_CSV_A}),
p AS (SELECT doc_id, {_jsplit('line', "','")} AS parts FROM l)
SELECT doc_id, CASE WHEN TRY_CAST(replace(parts[1], '"', '') AS DOUBLE) = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
       parts[6] AS sentence
FROM p WHERE TRY_CAST(replace(parts[1], '"', '') AS DOUBLE) IS NOT NULL AND parts[6] IS NOT NULL""",
    "csv_label_quoted": f"""
SELECT doc_id, CASE WHEN quality = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label, one_line AS sentence FROM ({_CSV_A})""",
    "csv_layout_b": f"""
WITH l AS (SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) || ',' || CAST(l.quality AS VARCHAR) || ',' || d.source
                  || ',' || {_ONE_LINE.replace('text', 'd.text')} AS line
           FROM documents d JOIN labels l USING (doc_id)),
p AS (SELECT doc_id, {_jsplit('line', "','")} AS parts FROM l)
SELECT doc_id, CASE WHEN TRY_CAST(parts[2] AS DOUBLE) = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label, parts[4] AS sentence
FROM p WHERE TRY_CAST(parts[2] AS DOUBLE) IS NOT NULL AND parts[4] IS NOT NULL""",
    "tsv_default_label": f"""
WITH d AS (SELECT doc_id, regexp_replace(text, '\\r\\n|\\r|\\n|\\t', ' ', 'g') AS t FROM documents),
l AS (SELECT d.doc_id, CASE WHEN lb.quality IS NULL THEN d.t ELSE d.t || chr(9) || CAST(lb.quality AS VARCHAR) END AS line
      FROM d LEFT JOIN labels lb USING (doc_id)),
p AS (SELECT doc_id, {_jsplit('line', 'chr(9)')} AS parts FROM l)
SELECT doc_id, CASE WHEN len(parts) < 2 THEN 1.0 ELSE TRY_CAST(parts[2] AS DOUBLE) END AS label, parts[1] AS sentence
FROM p WHERE NOT (len(parts) >= 2 AND TRY_CAST(parts[2] AS DOUBLE) IS NULL)""",
    "tsv_label_first": f"""
WITH d AS (SELECT doc_id, regexp_replace(text, '\\r\\n|\\r|\\n|\\t', ' ', 'g') AS t FROM documents),
l AS (SELECT d.doc_id, CAST(lb.quality AS VARCHAR) || chr(9) || d.t AS line FROM d JOIN labels lb USING (doc_id)),
p AS (SELECT doc_id, {_jsplit('line', 'chr(9)')} AS parts FROM l)
SELECT doc_id, TRY_CAST(parts[1] AS DOUBLE) AS label, parts[2] AS sentence
FROM p WHERE TRY_CAST(parts[1] AS DOUBLE) IS NOT NULL AND parts[2] IS NOT NULL""",
    "union_all": f"""
SELECT doc_id, label, unnest({_lines('sentence')}) AS sentence FROM ({_LABELLED})""",
    "tokens": f"""
SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS term
FROM (SELECT doc_id, {_tokens('text')} AS toks FROM documents)""",
    "tf": f"""
WITH toks AS (SELECT doc_id, unnest({_tokens('text')}) AS term FROM documents)
SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term""",
    "idf": _TF + "\nSELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf": _TF + """
SELECT tf.doc_id, tf.term, tf.tf, round(idf.idf, 6) AS idf, round(tf.tf * idf.idf, 6) AS tfidf
FROM tf JOIN idf USING (term)""",
    "train_test_subtract": f"SELECT doc_id, label, sentence FROM ({_LABELLED}) WHERE NOT ({_SPLIT})",
    "sample_60": f"SELECT doc_id, label FROM ({_LABELLED}) WHERE (((doc_id % 1000003) * 7919 + 29) % 1000003) % 100 < 60",
    "auc_by_rank": """
WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label
           FROM documents d JOIN labels l USING (doc_id)),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mr FROM s),
t AS (SELECT sum(CASE WHEN label > 0 THEN mr ELSE 0 END) AS rp,
             sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN label > 0 THEN 0 ELSE 1 END) AS q FROM r)
SELECT round((rp - p * (p + 1) / 2.0) / (p * q), 6) AS auc, CAST(p AS BIGINT) AS n_pos, CAST(q AS BIGINT) AS n_neg
FROM t""",
    "nb_predict_exact": f"""
WITH sp AS (SELECT *, {_SPLIT} AS is_train FROM ({_LABELLED})),
train AS (SELECT * FROM sp WHERE is_train),
test AS (SELECT * FROM sp WHERE NOT is_train),
tr_tf AS (SELECT doc_id, term, count(*) AS tf
          FROM (SELECT doc_id, unnest({_tokens('sentence')}) AS term FROM train) GROUP BY doc_id, term),
cnt AS (SELECT count(*)::DOUBLE AS n, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::DOUBLE AS n0,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS n1 FROM train),
idf AS (SELECT term, ln(((SELECT n FROM cnt) + 1) / (count(*) + 1)) AS idf FROM tr_tf GROUP BY term),
tr_x AS (SELECT t.term, tr.label, t.tf * i.idf AS x FROM tr_tf t JOIN idf i USING (term) JOIN train tr USING (doc_id)),
per_term AS (SELECT term, ln(sum(CASE WHEN label = 0 THEN x ELSE 0 END) + 1) AS lg0,
                    ln(sum(CASE WHEN label = 1 THEN x ELSE 0 END) + 1) AS lg1 FROM tr_x GROUP BY term),
k AS (SELECT (SELECT count(*) FROM idf)::DOUBLE AS v,
             (SELECT coalesce(sum(x), 0) FROM tr_x WHERE label = 0) AS s0,
             (SELECT coalesce(sum(x), 0) FROM tr_x WHERE label = 1) AS s1),
te_tf AS (SELECT doc_id, term, count(*) AS tf
          FROM (SELECT doc_id, unnest({_tokens('sentence')}) AS term FROM test) GROUP BY doc_id, term),
te_x AS (SELECT t.doc_id, t.tf * i.idf AS x, p.lg0, p.lg1 FROM te_tf t JOIN idf i USING (term) JOIN per_term p USING (term)),
sums AS (SELECT doc_id, sum(x * lg0) AS p0, sum(x * lg1) AS p1, sum(x) AS sx FROM te_x GROUP BY doc_id),
sc AS (SELECT te.doc_id, te.label, coalesce(s.p0, 0) AS p0, coalesce(s.p1, 0) AS p1, coalesce(s.sx, 0) AS sx
       FROM test te LEFT JOIN sums s USING (doc_id))
SELECT doc_id, label,
       CASE WHEN (ln(cnt.n1 + 1) - ln(cnt.n + 2)) + p1 - ln(k.s1 + k.v) * sx
               > (ln(cnt.n0 + 1) - ln(cnt.n + 2)) + p0 - ln(k.s0 + k.v) * sx THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM sc, cnt, k""",
    "key_role_lookup": """
SELECT c.c_name AS username, o.o_orderpriority AS role
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_name = 'Customer#000000001'""",
    "text_file_words": _WORDS.replace("FROM documents)", "FROM documents WHERE text != '')"),
    "word_count_running_turns": f"""
WITH l AS (SELECT turn AS batch, unnest({_lines('text')}) AS line FROM conversations),
w AS (SELECT batch, unnest({_jsplit('line', "' '")}) AS word FROM l),
per AS (SELECT word, batch, count(*) AS n FROM w GROUP BY word, batch)
SELECT word, batch, n AS batch_n, CAST(sum(n) OVER (PARTITION BY word ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM per""",
    "word_count_every_turn": f"""
WITH l AS (SELECT turn AS batch, unnest({_lines('text')}) AS line FROM conversations),
w AS (SELECT batch, unnest({_jsplit('line', "' '")}) AS word FROM l),
per AS (SELECT word, batch, count(*) AS n FROM w GROUP BY word, batch)
SELECT word, b.batch, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT DISTINCT turn AS batch FROM conversations) b JOIN per ON per.batch <= b.batch GROUP BY word, b.batch""",
    "sensor_lines": """
WITH h AS (SELECT *, md5(CAST(user_id AS VARCHAR)) AS h FROM events),
u AS (SELECT *, concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) AS uuid FROM h),
l AS (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(uuid, 2) ELSE uuid END AS sid,
             coalesce(CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR), '') AS hr, coalesce(json_extract_string(props, '$.k'), '') AS cal FROM u),
k AS (SELECT *, length(sid) = 36 AND TRY_CAST(hr AS INTEGER) IS NOT NULL AND TRY_CAST(cal AS INTEGER) IS NOT NULL AS ok FROM l)
SELECT event_id, ok, CASE WHEN ok THEN sid END AS session_id, CASE WHEN ok THEN CAST(hr AS INTEGER) END AS heart_rate,
       CASE WHEN ok THEN TRY_CAST(cal AS INTEGER) END AS calorie, CASE WHEN NOT ok THEN sid || ',' || hr || ',' || cal END AS rejected FROM k""",
    "tweet_upsert_by_id": f"""
SELECT id_str AS row_key, 'twt' AS family, 'createdat' AS qualifier, created_at AS value
FROM (SELECT *, row_number() OVER (PARTITION BY id_str ORDER BY "timestamp" DESC, "offset" DESC) AS rn
      FROM ({_TWEETS})) WHERE rn = 1""",
    "hashing_tf_mass": f"SELECT doc_id, CAST(len({_tokens('sentence')}) AS BIGINT) AS n_tokens FROM ({_LABELLED})",
    "libsvm_tf_mass": f"SELECT doc_id, CAST(len({_tokens('sentence')}) AS BIGINT) AS n_tokens FROM ({_LABELLED})",
    "svm_label_counts": f"""
SELECT label, count(*) AS n FROM (
  SELECT CASE WHEN label = 0 THEN '0.0' ELSE '1.0' END AS label FROM ({_LABELLED}) WHERE NOT ({_SPLIT})
  UNION ALL SELECT 'none' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) GROUP BY label""",
}

ORACLE_SQL["linear_score_auc"] = ORACLE_SQL["auc_by_rank"].replace(
    "CAST(d.n_chars AS DOUBLE) AS score", "d.n_chars * 0.25::DOUBLE - (d.doc_id % 7) * 64.0::DOUBLE AS score")
ORACLE_SQL["nb_exact_accuracy"] = f"""
SELECT round(count(*) FILTER (label = prediction) / count(*), 6) AS accuracy, count(*) FILTER (label = prediction) AS n_correct,
       count(*) AS n_test FROM ({ORACLE_SQL["nb_predict_exact"]})"""

# Murmur3 (32 bits, seed 42) of the UTF-8 bytes of a term, and its bucket.
_MUL = lambda a, b: f"(({a}) * {b}::UBIGINT % 4294967296::UBIGINT)"
_ROTATE = lambda x, r: f"((({x}) << {r}) % 4294967296::UBIGINT + (({x}) >> {32 - r}))"
_SCRAMBLE = lambda k: _MUL(_ROTATE(_MUL(k, 3432918353), 15), 461845907)
_BUCKETS = 65

_HASHED = f"""
words AS (SELECT doc_id, label, is_train, unnest(toks) AS term FROM lab),
terms AS (SELECT term, list_transform(range(len(hex(term)) // 2), lambda i: ('0x' || substr(hex(term), 2 * i + 1, 2))::INTEGER::UBIGINT) AS b
          FROM (SELECT DISTINCT term FROM words)),
blocks AS (SELECT term, b, len(b) AS n, list_transform(range(len(b) // 4), lambda i:
             b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) AS k FROM terms),
body AS (SELECT term, b, n, list_reduce(list_prepend(42::UBIGINT, list_transform(k, lambda x: {_SCRAMBLE('x')})),
             lambda h, x: ({_ROTATE('xor(h, x)', 13)} * 5 + 3864292196::UBIGINT) % 4294967296::UBIGINT) AS h FROM blocks),
tail AS (SELECT term, n, xor(h, {_SCRAMBLE("(CASE WHEN n % 4 >= 1 THEN b[n - n % 4 + 1] ELSE 0::UBIGINT END"
                                         " + CASE WHEN n % 4 >= 2 THEN b[n - n % 4 + 2] * 256 ELSE 0::UBIGINT END"
                                         " + CASE WHEN n % 4 >= 3 THEN b[n - n % 4 + 3] * 65536 ELSE 0::UBIGINT END)")}) AS h FROM body),
m1 AS (SELECT term, xor(h, n::UBIGINT) AS h FROM tail),
m2 AS (SELECT term, {_MUL('xor(h, h >> 16)', 2246822507)} AS h FROM m1),
m3 AS (SELECT term, {_MUL('xor(h, h >> 13)', 3266489909)} AS h FROM m2),
m4 AS (SELECT term, xor(h, h >> 16)::BIGINT AS h FROM m3),
hashed AS (SELECT term, CAST(((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {_BUCKETS} + {_BUCKETS}) % {_BUCKETS} AS INTEGER) AS bucket FROM m4),
cells AS (SELECT doc_id, label, is_train, bucket, count(*) AS tf FROM words JOIN hashed USING (term) GROUP BY ALL),
idf AS (SELECT b.bucket, ln(((SELECT count(*) FROM lab WHERE is_train) + 1.0) / (count(c.doc_id) + 1.0)) AS idf
        FROM (SELECT DISTINCT bucket FROM cells) b LEFT JOIN cells c ON c.bucket = b.bucket AND c.is_train GROUP BY b.bucket)"""

_CELLS = f"""WITH lab AS (SELECT doc_id, label, {_SPLIT} AS is_train, {_tokens('sentence')} AS toks FROM ({_LABELLED})), {_HASHED}"""

ORACLE_SQL["hashing_tfidf_cells"] = _CELLS + """
SELECT doc_id, label, bucket, tf, round(tf * idf, 6) AS tfidf FROM cells JOIN idf USING (bucket)"""
ORACLE_SQL["libsvm_cells"] = _CELLS + """
SELECT doc_id, bucket, round(tf * idf, 6) AS tfidf FROM cells JOIN idf USING (bucket) WHERE tf * idf <> 0"""

# Five subgradient steps over the training cells, from weights of 0.
_STEP = """,
g{t} AS (SELECT x.doc_id, x.copy, sum(x.v * w.w) AS margin FROM x JOIN w{last} w USING (bucket) GROUP BY x.doc_id, x.copy),
w{t} AS (SELECT w.bucket, w.w * (1 - 0.01::DOUBLE / sqrt({t}::DOUBLE)) + coalesce(s.s, 0) / (SELECT n FROM size) / sqrt({t}::DOUBLE) AS w
         FROM w{last} w LEFT JOIN (SELECT x.bucket, sum((2 * label - 1) * x.v) AS s FROM x JOIN g{t} USING (doc_id, copy)
                                   WHERE (2 * label - 1) * margin < 1 GROUP BY x.bucket) s USING (bucket))"""
ORACLE_SQL["svm_step_weights"] = _CELLS + """,
x AS (SELECT doc_id, 1 AS copy, label, bucket, tf * idf AS v FROM cells JOIN idf USING (bucket) WHERE is_train),
size AS (SELECT count(*)::DOUBLE AS n FROM lab WHERE is_train),
w0 AS (SELECT CAST(unnest(range(65)) AS INTEGER) AS bucket, 0.0::DOUBLE AS w)""" + "".join(
    _STEP.format(t=t, last=t - 1) for t in range(1, 6)) + """
SELECT bucket, round(w, 6) AS weight FROM w5"""
