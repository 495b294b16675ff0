import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import views
from textlab.operators.chunking import chunks
from textlab.operators.embedding import embed, embed_query
from textlab.operators.enrich import enrich
from textlab.operators.search import filters, search
from textlab.plans import comparisons, overview, retrieval
from textlab.schemas import SECTIONS, SENTENCES, UNUSED_SENTENCE_COLUMNS, check_schema, section_dimension
from textlab.sources import files
from textlab.sources.vector_table import VectorTable, drop_all


def test_run_writes_every_stage(spark, sf, tmp_path):
    table = VectorTable(spark, "demo", "plans_test")
    table.drop()
    options = dict(sections=views.sections(spark), target=str(tmp_path), table=table, query="main risk factors", k=5,
                   sample_size=500, embedding={"dim": 32})
    metrics = {r.key: r.value for r in retrieval.run(spark, views.sentences(spark, sf), **options).collect()}
    assert metrics["row_count"] == 500
    assert metrics["chunk_count"] == metrics["embeddings_created"] == metrics["vectors_stored"]
    assert metrics["validation_results"] == 5
    assert files.read_parquet(spark, f"{tmp_path}/embedded").count() == metrics["chunk_count"]
    again = {r.key: r.value for r in retrieval.run(spark, views.sentences(spark, sf), **options).collect()}
    assert again == metrics
    drop_all(spark, "plans_test")


def test_gate_stops_an_empty_run(spark, sf, tmp_path):
    table = VectorTable(spark, "empty", "plans_test")
    table.drop()
    with pytest.raises(ValueError):
        schema = retrieval.embedded_chunks(views.sentences(spark, sf), views.sections(spark)).schema
        table.ensure(schema, 64)
        retrieval.run(spark, views.sentences(spark, sf).limit(0), views.sections(spark), str(tmp_path), table, "risk")
    drop_all(spark, "plans_test")


def test_entry(spark):
    import __spark_entry__ as entry

    found = entry.entry(spark).collect()
    assert len(found) == 10
    assert [r.score for r in found] == sorted((r.score for r in found), reverse=True)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stage_files(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], 0.5), (2, None, None)], "i int, t array<string>, x double")
    files.write_json(df, str(tmp_path / "j"))
    assert {tuple(map(str, r)) for r in files.read_json(spark, str(tmp_path / "j"), df.schema).collect()} == {
        tuple(map(str, r)) for r in df.collect()}
    files.write_parquet(df, str(tmp_path / "p"))
    assert any(f.name.endswith(".snappy.parquet") for f in (tmp_path / "p").iterdir())
    assert files.read_parquet(spark, str(tmp_path / "p"), df.schema).count() == 2
    wrong = T.StructType([T.StructField("i", T.StringType())])
    with pytest.raises(ValueError, match="i: expected string, got int"):
        files.read_parquet(spark, str(tmp_path / "p"), wrong)
    with pytest.raises(ValueError, match="missing_one"):
        check_schema(df, T.StructType([T.StructField("missing_one", T.StringType())]))


def test_source_info(spark, sf, tmp_path):
    info = files.source_info(spark, f"{sf}/documents.parquet").first()
    assert (info.total_rows, info.total_columns, info.n_files, info.exists) == (200, 5, 1, True)
    assert info.size_mb > 0
    assert files.exists(spark, f"{sf}/documents.parquet") and files.exists(spark, sf)
    missing = files.source_info(spark, str(tmp_path / "nothing")).first()
    assert (missing.exists, missing.total_rows) == (False, 0)


def test_source_info_counts_files_without_rows(spark, tmp_path):
    for name, rows in (("a", 5), ("b", 0)):
        spark.range(rows).repartition(1).write.parquet(f"{tmp_path}/{name}")
    (tmp_path / "both").mkdir()
    parts = [f for name in ("a", "b") for f in (tmp_path / name).glob("*.parquet")]
    for part in parts:
        (tmp_path / "both" / part.name).write_bytes(part.read_bytes())
    both = files.source_info(spark, str(tmp_path / "both")).first()
    assert (both.n_files, both.total_rows, both.total_columns) == (len(parts), 5, 1) and len(parts) == 2  # one of them holds no row


def test_spread(spark, sf):
    scan = spark.read.parquet(f"{sf}/documents.parquet")
    assert files.spread(scan, "doc_id").rdd.getNumPartitions() == 4
    wide = spark.range(100, numPartitions=9)
    assert files.spread(wide, "id") is wide


def test_section_dimension(spark):
    dimension = views.sections(spark)
    assert dimension.count() == len(SECTIONS) == 15
    by_priority = {r.priority: r["count"] for r in dimension.groupBy("priority").count().collect()}
    assert by_priority == {"highest": 1, "high": 4, "medium": 5, "low": 5}
    assert dimension.filter(F.col("note").isNotNull()).count() == 3


def filing_rows():
    day = datetime.date
    companies = [("ACME CORP", "11", ["AC", "AX"]), ("Widget Inc", "22", ["W"]), (None, "33", None)]
    for d in range(6):
        name, cik, tickers = companies[d % 3]
        for section in (1, 8, 13, 14):
            for i in range(d + 2):
                text = ["Risk is high in this market", "1 2 3 4", "NA", "We sell widgets to many customers"][(i + d) % 4]
                filed, reported = day(2020, 1, 1 + d), day(2019, 12, 1 + d)
                yield (f"doc{d}", i, section, text, name, cik, tickers, filed, reported, 1, 0, 9)


def test_a_whole_filing_table(spark, tmp_path):
    spark.createDataFrame(list(filing_rows()), SENTENCES).write.parquet(str(tmp_path / "s"))
    df = files.read_parquet(spark, str(tmp_path / "s"), SENTENCES)
    rows = list(filing_rows())
    report = {(r.part, r["item"]): (r.value, r.text)
              for r in overview.as_rows(df, overview.overall_stats(df, lists=["tickers"])).collect()}
    assert report["shape", "rows"][0] == len(rows)
    assert report["unique", "name"][0] == 3 and report["unique", "tickers"][0] == 4
    assert report["dates", "earliest"][1] == "2020-01-01"
    assert report["missing", "name"][0] == sum(r[4] is None for r in rows)
    assert report["top_groups", None][0] == report["missing", "name"][0]
    assert comparisons.filter_contains(df, "name", "CORP").count() == sum(r[4] == "ACME CORP" for r in rows)

    dimension = section_dimension(spark)
    enriched = enrich(df, dimension)
    assert set(UNUSED_SENTENCE_COLUMNS).isdisjoint(enriched.columns)
    assert enriched.count() == sum(len(r[3].split(" ")) >= 3 for r in rows)
    table = embed(chunks(enriched, dimension), dim=32)
    where = filters(company="ACME CORP", date_range=("2019-12-01", "2019-12-03"), high_priority_only=True)
    hits = search(table, embed_query(spark, "risk in this market", dim=32), 10, where).collect()
    assert hits and all(h.company == "ACME CORP" and h.section in (1, 8) and h.docID == "doc0" for h in hits)
    assert {r.section_name for r in table.select("section_name").collect()} == {
        "Risk Factors", "MD&A", "Unknown", "Section_14"}
