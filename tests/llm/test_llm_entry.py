"""Every query of the subpackage runs on the smallest tables, and agrees with its SQL where there is some."""

from collections import Counter
from pathlib import Path

import pytest

from subloom.llm import catalogue

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="the test tables aren't here")
COLUMNS = {"p1_found": ["record_kind", "record_id", "language"], "p2_found": ["event_id"], "p3_found": ["movie_id", "event_index", "cast_id"], "p5_found": ["id_a", "id_b"], "p6_found": ["movie_id_a", "movie_id_b"], "p7_found": ["first_id", "record_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "reading_band"]}


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, name):
    df = catalogue.queries()[name](spark, DIR)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
    rows = df.collect()
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    sql = catalogue.oracle_sql().get(name)
    if sql:
        con = pytest.importorskip("duckdb").connect()
        for p in Path(DIR).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        assert Counter(tuple(r) for r in rows) == Counter(tuple(r[names.index(c)] for c in df.columns) for r in rel.fetchall())


def test_every_document_has_a_level(spark):
    read = lambda n: spark.read.parquet(f"{DIR}/{n}.parquet")
    levels = {r["doc_id"]: r for r in catalogue.queries()["p10_levels"](spark, DIR).collect()}
    texts = {r["doc_id"]: r["text"] for r in read("documents").filter("text IS NOT NULL").collect()}
    assert levels.keys() == texts.keys() and all(r["reading_band"] in (1, 2, 3, 4) for r in levels.values())
    assert all(r["level"] == 0 and r["language"] is None for r in levels.values() if not texts[r["doc_id"]].strip())
    found = catalogue.queries()["p10_found"](spark, DIR).collect()
    assert found and all((levels[r["doc_id"]]["reading_band"], levels[r["doc_id"]]["language"]) == (r["reading_band"], "en") for r in found)
    assert {r["language"] for r in levels.values()} > {"en", "mn"} and min(r["n_words"] for r in levels.values()) < 40
    assert sum(r["n_docs"] for r in catalogue.queries()["p10_profile"](spark, DIR).collect()) == len(texts)
