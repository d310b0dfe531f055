import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    """Run DuckDB SQL over the tables of a folder."""
    def run(sql, sf=SF):
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet') as q_{t}")
        return con.sql(sql).df()
    return run


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}
