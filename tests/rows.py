"""Small literal tables."""

from datetime import datetime

from shopweave.sources.schema import SCHEMAS

DAY = datetime(2024, 5, 1)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def post(id, kind="shop_order", status="wc-completed", title="t", date=DAY, **other):
    values = {"name": "", "excerpt": "", "content": "", **other}
    return (
        id,
        1,
        kind,
        status,
        title,
        values["name"],
        values["excerpt"],
        values["content"],
        values.get("local", date),
        date,
        date,
        date,
        0,
    )


def posts(spark, *rows):
    return table(spark, "posts", list(rows))


def postmeta(spark, *rows):
    """Rows are (post_id, key, value); meta ids count up in the order given."""
    return table(spark, "postmeta", [(i, *row) for i, row in enumerate(rows, start=1)])


def values(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
