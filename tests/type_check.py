"""Compare Spark and DuckDB result column types for every registered query."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "array<string>": "VARCHAR[]", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "float": "FLOAT", "smallint": "SMALLINT"}


def main():
    from oracle_check import duck_connect
    from probity.session import get_session
    import __spark_entry__ as e
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=4)
    con = duck_connect(sf)
    sqls = e.oracle_sql()
    bad = 0
    for name, build in e.queries().items():
        if name not in sqls:
            continue
        sp = {f.name: f.dataType.simpleString() for f in build(spark, sf).schema.fields}
        rel = con.sql(sqls[name])
        dk = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diffs = [(c, sp[c], dk.get(c)) for c in sp if SPARK_TO_DUCK.get(sp[c], sp[c]) != dk.get(c)]
        if diffs:
            bad += 1
            print(name, diffs)
    print("type mismatches:", bad)


if __name__ == "__main__":
    main()
