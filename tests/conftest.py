import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def same_rows(df, con, sql):
    """Both sides' rows, sorted, with values made comparable."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)

    def plain(v):
        if isinstance(v, float):
            return float(f"{v:.10g}")
        return v

    def rows(values, columns):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)

    got, want = rows([tuple(r) for r in df.collect()], df.columns), rows(cursor.fetchall(), names)
    assert got == want
    return got
