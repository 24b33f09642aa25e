import duckdb
import pytest


@pytest.fixture(scope="session")
def oracle():
    """Rows of an oracle over the test tables of a folder, as a sorted list of dicts' items."""
    def run(sql, sf_dir):
        con = duckdb.connect()
        for t in "documents pages benchmark labels conversations embeddings".split():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        return sorted((tuple(sorted(zip(names, r, strict=True))) for r in rel.fetchall()), key=str)
    return run


@pytest.fixture(scope="session")
def rows_of():
    def run(df):
        return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)
    return run
