"""Secret scans with multipart credential linking, DataFrame functions only.

Base kinds (`assign`, `access`, `hex`) are reported wherever they match. Weak
candidates - identifiers (`id`), passwords and mixed tokens (`pass`, `key`),
endpoints (`url`) - say little alone, so an interval join links them: parts
whose starts lie within `SCOPE` code points of each other share a scope, and a
weak part is reported only if its complement stands in its scope:

* an identifier with a secret;
* a secret with an identifier or an endpoint;
* an endpoint with both an identifier and a secret.

Scopes never leave a document, so the join runs over a document's sorted part
list and shuffles nothing: matches of one kind do not overlap and are at least
`MIN_PART` long, so a scope spans at most `SCOPE / MIN_PART + 1` parts of a kind
on each side, and each part looks at that many neighbours only.

Positions are code points. They come from splitting a text at the matches: the
lengths of the pieces and matches, summed in runs, give every start in time
linear in the text.

Nulls and edge cases: null text counts as empty and has no spans; identical rows
give identical results; an empty table gives an empty result; input columns
whose names clash with the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import or_empty, quoted, table, without


def either_case(*alternatives: str) -> str:
    """Alternatives whose ASCII letters match in either case."""
    return "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in a) for a in alternatives)


_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# The kinds in reporting order as (kind, pattern, least length of
# its group 2 or of the match, role, weak).
ID, SECRET, ENDPOINT = 0, 1, 2
KINDS = (
    ("assign", "(" + either_case("password", "passwd", "secret", "token", "api_?key") + ")" + _ASSIGNED, 12, SECRET, False),
    ("access", "AKIA[A-Z0-9]+", 18, ID, False),
    ("hex", "[0-9a-f]+", 16, SECRET, False),
    ("id", "(" + either_case("access_?key_?id", "client_?id", "username", "user", "login", "account") + ")" + _ASSIGNED, 3, ID, True),
    ("key", "[A-Za-z0-9+/]{24,}", 24, SECRET, True),
    ("pass", "(" + either_case("pwd", "pass", "credential", "private_?key") + ")" + _ASSIGNED, 4, SECRET, True),
    ("url", "(" + either_case("https", "http", "ftp", "postgresql", "postgres", "mysql", "mongodb", "redis", "amqp") + ")://([A-Za-z0-9._~:/?#@%&=+-]+)", 4, ENDPOINT, True),
)
GROUPED = ("assign", "id", "pass", "url")
HEX_SECRET = 32     # a shorter run of hex digits is reported, but completes no credential
SCOPE = 300
MIN_PART = 6
RUN = 256

STRETCH = 2048  # characters masked at a time
RESULT = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "span_list")


def _running(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds `name`: exclusive running sums of an array column, in runs of RUN."""
    n = F.size(column)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / RUN).cast("int") - 1)),
                       lambda b: F.slice(column, b * RUN + 1, F.lit(RUN)))
    zero = F.lit(0).cast("long")
    empty = F.array().cast("array<bigint>")
    start = F.struct(zero.alias("s"), empty.alias("out"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["s"] + x).alias("s"), F.array_append(acc["out"], acc["s"]).alias("out"))

    df = df.withColumn("__runs", F.transform(runs, lambda r: F.aggregate(r, start, add)))
    base = F.aggregate(F.transform("__runs", lambda r: r["s"]), start, add)["out"]
    return df.withColumn(name, F.flatten(F.zip_with("__runs", base, lambda r, b: F.transform(r["out"], lambda x: x + b)))) \
        .drop("__runs")


def _may_match(t: Column, kind: str) -> Column:
    """A cheap test that every text with a passing match of a kind meets."""
    if kind == "hex":
        return t.rlike("[0-9a-f]{16}")
    if kind == "key":
        return t.rlike("[0-9]")
    return t.contains({"access": "AKIA", "url": "://"}[kind]) if kind in ("access", "url") else t.contains("=") | t.contains(":")


def _parts(df: DataFrame, text: str, order: int, kind: str, pattern: str, least: int, role: int, weak: bool) -> DataFrame:
    """Adds the matches of one kind as an array of parts in column `__<kind>`."""
    t = F.col(text)
    none = F.array().cast("array<string>")
    df = df.withColumn("__m", F.when(_may_match(t, kind), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none)) \
        .withColumn("__g", F.when(F.size("__m") > 0, F.split(t, pattern, -1)).otherwise(none))
    df = df.withColumn("__len", F.transform("__m", lambda m, i: F.length(m) + F.length(F.get("__g", i)).cast("long")))
    df = _running(df, "__len", "__before")
    size = (lambda m: F.length(F.regexp_extract(m, pattern, 2))) if kind in GROUPED else F.length
    spans = F.transform("__m", lambda m, i: F.struct(
        (F.get("__before", i) + F.length(F.get("__g", i))).alias("start"), F.lit(order).alias("kind"),
        (F.get("__before", i) + F.length(F.get("__g", i)) + F.length(m)).alias("end"), F.lit(role).alias("role"),
        F.lit(weak).alias("weak"), (size(m) >= least).alias("ok"), m.alias("match")))
    ok = F.filter(spans, lambda p: p["ok"])
    if kind == "key":
        mixed = lambda p: p["match"].rlike("[a-z]") & p["match"].rlike("[A-Z]") & p["match"].rlike("[0-9]")
        ok = F.filter(spans, lambda p: p["ok"] & mixed(p))
    if kind == "hex":
        ok = F.transform(ok, lambda p: p.withField("role", F.when(p["end"] - p["start"] >= HEX_SECRET, p["role"]).otherwise(F.lit(-1))))
    return df.withColumn(f"__{kind}", F.transform(ok, lambda p: F.struct(
        p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"), p["role"].alias("role"),
        p["weak"].alias("weak")))).drop("__m", "__g", "__len", "__before")


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """`docs` with the base counts and digest, all spans as a string, and
    `span_list`, an array of (start, kind, end, role, weak)."""
    rest = without(docs, RESULT)
    df = docs.select(*rest, or_empty(quoted(text)).alias("__t"))
    for order, k in enumerate(KINDS):
        df = _parts(df, "__t", order, *k)
    df = df.withColumn("__base", F.sort_array(F.concat("__assign", "__access", "__hex"))) \
        .withColumn("__parts", F.sort_array(F.concat(*[F.col(f"__{k[0]}") for k in KINDS])))
    reach = (scope // MIN_PART + 1) * len(KINDS)

    def linked(p: Column, i: Column) -> Column:
        near = F.slice("__parts", F.greatest(F.lit(1), i + 1 - reach), F.lit(2 * reach + 1))
        has = lambda role: F.exists(near, lambda q: (q["role"] == role) & (F.abs(q["start"] - p["start"]) <= scope))
        return F.when(~p["weak"], F.lit(True)).when(p["role"] == ID, has(SECRET)) \
            .when(p["role"] == SECRET, has(ID) | has(ENDPOINT)).otherwise(has(ID) & has(SECRET))

    df = df.withColumn("span_list", F.filter("__parts", linked))
    return df.select(*rest, *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
                     F.sha2(_shown(F.col("__base")), 256).alias("base_sha256"),
                     _shown(F.col("span_list")).alias("spans"), "span_list")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows and columns of `docs`, every reported span of the text replaced
    by `mark` (overlapping spans by one). Null texts stay null.

    A text with spans is cut into stretches of `STRETCH` characters by one pass of a
    pattern, and each stretch is masked on its own: a span that goes on into the
    next stretch is marked where it starts. So no piece is searched for from the
    start of the text, and no list of all spans is copied for each span."""
    found = scan(docs.select("*", quoted(text).alias("__whole")), "__whole")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    long = lambda x: x.cast("long")
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731 - `value` is computed once for all its uses

    def masked(spans: Column, piece: Column, number: Column) -> Column:
        lo = long(number) * STRETCH
        near = F.transform(F.filter(spans, lambda p: (p["start"] < lo + STRETCH) & (p["end"] > lo)),
                           lambda p: F.struct(long(p["start"]).alias("start"), long(p["end"]).alias("end")))
        return F.when(F.size(near) == 0, piece).otherwise(once(F.aggregate(near, none, lambda acc, p: F.when(
            (F.size(acc) > 0) & (p["start"] < F.element_at(acc, -1)["end"]),
            F.array_append(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.struct(
                F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], p["end"]).alias("end"))))
            .otherwise(F.array_append(acc, p))), lambda merged: cut(piece, lo, merged)))

    def cut(piece: Column, lo: Column, spans: Column) -> Column:
        after = lambda i: F.greatest(F.coalesce(F.get(spans, i)["end"], lo), lo)
        parts = F.transform(spans, lambda c, i: F.concat(
            F.substring(piece, (after(i - 1) - lo + 1).cast("int"), F.greatest(c["start"] - after(i - 1), F.lit(0)).cast("int")),
            F.when(c["start"] >= lo, F.lit(mark)).otherwise(F.lit(""))))
        return F.concat(F.array_join(parts, ""), F.substring(piece, (after(F.size(spans) - 1) - lo + 1).cast("int"), F.lit(STRETCH)))

    t = F.col("__whole")
    stretches = F.regexp_extract_all(t, F.lit(f"(?s)(.{{1,{STRETCH}}})"), F.lit(1))
    clean = once(F.col("span_list"), lambda spans: F.when(F.size(spans) == 0, t).otherwise(
        F.array_join(F.transform(stretches, lambda piece, i: masked(spans, piece, i)), "")))
    return found.select(*[clean.alias(c) if c == text else quoted(c) for c in docs.columns])


def op8_secrets(spark: SparkSession, data_dir: str) -> DataFrame:
    return scan(table(spark, data_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _sql() -> str:
    quote = lambda s: s.replace("'", "''")
    kinds = []
    for order, (kind, pattern, least, role, weak) in enumerate(KINDS):
        size = f"length(regexp_extract(m, '{quote(pattern)}', 2))" if kind in GROUPED else "length(m)"
        extra = " AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')" if kind == "key" else ""
        shown_role = f"CASE WHEN length(m) >= {HEX_SECRET} THEN {role} ELSE -1 END" if kind == "hex" else str(role)
        kinds.append(f"""
  SELECT rid, '{kind}' AS name, {order} AS kind, s + g AS start, s + g + length(m) AS fin, {shown_role} AS role, {weak} AS weak FROM (
    SELECT rid, i, m, length(g) AS g, coalesce(sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM (
      SELECT rid, unnest(regexp_extract_all(t, '{quote(pattern)}')) AS m, unnest(string_split_regex(t, '{quote(pattern)}')) AS g,
             unnest(range(len(string_split_regex(t, '{quote(pattern)}')))) AS i FROM d)
  ) WHERE m IS NOT NULL AND {size} >= {least}{extra}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS ({" UNION ALL ".join(kinds)}),
c AS (
  SELECT a.rid, a.name, a.kind, a.start, a.fin,
         bool_or(b.role = {ID}) AS has_id, bool_or(b.role = {SECRET}) AS has_secret, bool_or(b.role = {ENDPOINT}) AS has_end,
         a.role, a.weak
  FROM p a JOIN p b ON a.rid = b.rid AND abs(a.start - b.start) <= {SCOPE} GROUP BY ALL
), r AS (
  SELECT rid, name, kind, start, fin, name || ':' || start || ':' || fin AS shown FROM c
  WHERE NOT weak OR (role = {ID} AND has_secret) OR (role = {SECRET} AND (has_id OR has_end))
     OR (role = {ENDPOINT} AND has_id AND has_secret)
), g AS (
  SELECT rid, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
         count(*) FILTER (name = 'hex') AS n_hex,
         string_agg(shown, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(shown, ',' ORDER BY start, kind) AS spans
  FROM r GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)
"""


OP8_SQL = _sql()
