import duckdb
import pytest


@pytest.fixture(scope="session")
def sql_rows():
    """Run SQL over named Spark frames in DuckDB; rows as sorted tuples, columns by name."""

    def run(sql, **tables):
        con = duckdb.connect()
        for name, df in tables.items():
            con.register(name, df.toArrow())
        result = con.execute(sql)
        return ordered([c[0] for c in result.description], result.fetchall())

    return run


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def spark_rows():
    return lambda df: ordered(df.columns, df.collect())
