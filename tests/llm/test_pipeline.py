"""Pipeline stages: each against a plain version over its own input."""

from collections import Counter

import duckdb

import corpus_pipeline as P
from spindle.llm.common import stage
from spindle.llm.decontaminate import OP2_SQL
from spindle.llm.mix import OP9_SQL
from spindle.llm.quality import OP6_SQL
from tests.conftest import SF001
from tests.llm.test_dedup import groups_by_definition


def table_rows(df):
    return Counter(tuple(r) for r in df.collect())


def with_docs(df, sql, folder):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{folder}/benchmark.parquet')")
    cur = con.execute(sql)
    return [dict(zip([d[0] for d in cur.description], r)) for r in cur.fetchall()]


def check_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, function in P.STAGES:
        before = docs.collect()
        docs = stage(function(spark, spark.read.schema(docs.schema).parquet(*docs.inputFiles()), folder), f"test-{name}")
        after = docs.collect()
        at = {c: columns.index(c) for c in ("doc_id", "text", "source")}
        ids = Counter(r[at["doc_id"]] for r in after)
        if name != "mixing":
            assert docs.columns == columns
        frame = spark.createDataFrame([tuple(r[at[c]] for c in at) for r in before], "doc_id long, text string, source string")
        if name == "quality":
            assert ids == Counter(r["doc_id"] for r in with_docs(frame, OP6_SQL, folder) if r["kept"])
        elif name == "near_duplicates":
            _, roots = groups_by_definition([r[at["text"]] for r in before], 5, 80)
            groups = Counter(roots[i] for i, r in enumerate(before) if (r[at["text"]] or "").split())
            empty = sum(not (r[at["text"]] or "").split() for r in before)
            assert len(after) == len(groups) + empty
        elif name == "decontamination":
            assert ids == Counter(r["doc_id"] for r in with_docs(frame, OP2_SQL, folder) if not r["contaminated"])
        elif name == "secrets":
            assert ids == Counter(r[at["doc_id"]] for r in before)
            assert not any("AKIA" in (r[at["text"]] or "") for r in after)
        else:
            want = Counter((r["doc_id"], r["size"], r["taken"]) for r in with_docs(frame, OP9_SQL, folder) if r["taken"] > 0)
            assert Counter((r.doc_id, r.size, r.taken) for r in after) == want
    return docs


def test_stages_on_the_smallest_tables(spark):
    last = check_stages(spark, SF001)
    assert table_rows(P.run(spark, SF001)) == table_rows(last)


def test_stages_on_edge_cases(spark, cases):
    check_stages(spark, cases)


def test_no_documents(spark, nothing):
    assert P.run(spark, nothing).count() == 0


def test_stages_call_the_dealt_operators():
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert P.ORACLE_SQL is None


def test_extra_columns_of_any_name_pass_every_stage(spark, cases):
    """Names that the operators use inside, and names of their results."""
    docs = spark.read.parquet(f"{cases}/documents.parquet").where("doc_id < 12 OR doc_id > 18")
    extra = docs.selectExpr("*", "'x' AS __src", "'y' AS __t", "doc_id AS taken", "7 AS target", "'z' AS `a.b`")
    for name, function in P.STAGES[2:]:
        out = function(spark, extra, cases)
        rows = out.collect()
        assert rows and all(r["__src"] == "x" and r["__t"] == "y" and r["a.b"] == "z" for r in rows), name
        if name != "mixing":
            assert out.columns == extra.columns


def test_masking_long_and_dense_texts(spark):
    """Spans across stretches, overlapping and adjacent ones: one mark each."""
    from spindle.llm import secrets

    key = "0123456789abcdef" * 2
    texts = [("é" * n + " " + key + " end") for n in range(secrets.STRETCH - 40, secrets.STRETCH + 4)] + [key * 200, " ".join([key] * 400), None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.text for r in secrets.redact(df).collect()]
    n = secrets.STRETCH + 4 - (secrets.STRETCH - 40)
    assert got[:n] == ["é" * k + " [SECRET] end" for k in range(secrets.STRETCH - 40, secrets.STRETCH + 4)]
    assert got[n:] == ["[SECRET]", " ".join(["[SECRET]"] * 400), None, ""]
