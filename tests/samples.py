"""Small literal frames."""

from pyspark.sql import types as T

from orderlake.contracts import LINE_TYPES, ORDER_LINEAGE, ORDER_TYPES
from orderlake.operators.standardize import conform, subset_contract

ORDER = dict(order_id="O1", customer_id="C1", order_date="2026-01-05", product_id="P1", quantity="2",
             unit_price="10.50", status="placed", payment_method="paypal", ingest_date="2026-06-01",
             source_filename="a.csv")
LINE = dict(order_id="1", customer_id="7", product_id="3", quantity="2", unit_price="10.50", region="ASIA",
            status="PLACED", order_date="2026-01-05", line_item_seq="1", ingest_date="2026-06-01",
            _source_file="a.csv")


def text_frame(spark, base, changes):
    rows = [{**base, **change} for change in changes]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in base])
    return spark.createDataFrame([tuple(row[name] for name in base) for row in rows], schema)


def orders(spark, *changes):
    contract = T.StructType(ORDER_TYPES.fields + ORDER_LINEAGE.fields)
    return conform(text_frame(spark, ORDER, changes), subset_contract(contract, list(ORDER)))


def lines(spark, *changes):
    return conform(text_frame(spark, LINE, changes), LINE_TYPES)


def write_csv(path, header, rows):
    """Rows of dicts as one CSV file; None is an empty field."""
    with open(path, "w") as out:
        out.write(",".join(header) + "\n")
        for row in rows:
            out.write(",".join("" if row[h] is None else str(row[h]) for h in header) + "\n")
    return str(path)


def values(frame, *columns):
    chosen = columns or frame.columns
    return sorted((tuple(row[c] for c in chosen) for row in frame.collect()), key=repr)
