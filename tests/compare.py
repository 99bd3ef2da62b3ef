"""Runs a query in Spark and its oracle in DuckDB and compares whole results."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), canonical(names, cursor.fetchall())
