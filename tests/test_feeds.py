"""Status feeds from outside, and a catalogue file with line ends in its texts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import post, posts, table, values

from shopweave.fixed_values import CATALOG_COLUMNS
from shopweave.operators.statuses import sync_statuses_exact, sync_statuses_wide
from shopweave.plans.statuses import job_sync_file
from shopweave.plans.steps import Steps
from shopweave.plans.store import Store
from shopweave.sources.files import (
    NO_NUMBER,
    NOT_TWO_FIELDS,
    accepted_lines,
    read_catalog_csv,
    read_status_lines,
    rejected_lines,
    write_catalog_csv,
)

NOW = datetime(2025, 9, 14, 12)
LINES = [
    "1\twc-on-hold",
    "",
    "x\twc-failed",
    "2",
    " 3 \twc-pending",
    "99999999999999999999\twc-pending",
    "1\twc-completed",
    "4\ta\tb",
    "\twc-failed",
    "5\t",
    "-6\t\"quoted\" é\r",
]


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "part-0").write_text("\n".join(LINES) + "\n", encoding="utf-8", newline="")
    (folder / "part-1").write_text("5\twc-refunded\n3\twc-cancelled", encoding="utf-8")
    return str(folder)


def test_lines_are_usable_or_rejected(spark, feed):
    lines = read_status_lines(spark, feed)
    assert values(rejected_lines(lines).select("line", "reason")) == sorted(
        [
            ("\twc-failed", NO_NUMBER),
            ("2", NOT_TWO_FIELDS),
            ("4\ta\tb", NOT_TWO_FIELDS),
            ("99999999999999999999\twc-pending", NO_NUMBER),
            ("x\twc-failed", NO_NUMBER),
        ],
        key=repr,
    )
    found = sorted((r.file[-1], r.place, r.id, r.status) for r in accepted_lines(lines).collect())
    assert [x[2:] for x in found if x[0] == "0"] == [
        (1, "wc-on-hold"), (3, "wc-pending"), (1, "wc-completed"), (5, ""), (-6, '"quoted" é')
    ]
    assert lines.count() == 12


def test_header_is_no_line(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text("ID\tpost_status\n7\twc-x\n")
    lines = read_status_lines(spark, str(tmp_path), header=True)
    assert values(lines.select("id", "reason")) == [(7, None), (7, None)]


def test_last_line_of_an_order_counts(spark, feed, workspace):
    dst = posts(spark, *(post(i, status="wc-old") for i in (1, 3, 5, 8)))
    lines = accepted_lines(read_status_lines(spark, feed))
    after = sync_statuses_exact(dst, lines, NOW)
    expected = [(1, "wc-completed"), (3, "wc-cancelled"), (5, "wc-refunded"), (8, "wc-old")]
    assert values(after.select("id", "post_status")) == expected
    wide = spark.createDataFrame([(1, "old", NOW), (5, "old", NOW)], "id bigint, status string, date_updated_gmt timestamp_ntz")
    assert values(sync_statuses_wide(wide, lines, NOW).select("id", "status")) == [(1, "completed"), (5, "refunded")]


def test_many_blocks_keep_the_order_of_lines(spark, tmp_path):
    """A file that is read by several tasks: the last line still counts."""
    path = tmp_path / "large.tsv"
    path.write_text("".join(f"{i % 50}\ts{i}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = read_status_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() > 4
        dst = posts(spark, *(post(i) for i in range(50)))
        after = sync_statuses_exact(dst, accepted_lines(lines), NOW)
        found = dict(values(after.select("id", "post_status")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {i: f"s{59_950 + i}" for i in range(50)}


def test_job_returns_what_it_could_not_use(spark, feed, workspace):
    dst = Store(posts=posts(spark, post(1, status="wc-old"), post(8, status="wc-old")), options=table(spark, "options", []))
    steps = Steps()
    after, rejected = job_sync_file(spark, dst, feed, NOW, workspace, steps=steps)
    assert rejected.count() == 5
    seen = steps.values()
    assert (seen["feed", "accepted"], seen["feed", "rejected"]) == (7, 5)
    assert (seen["orders", "found"], seen["orders", "not_found"]) == (1, 1)
    assert values(after.posts.select("id", "post_status")) == [(1, "wc-completed"), (8, "wc-old")]


def test_every_text_survives_the_catalogue_file(spark, tmp_path):
    odd = ["plain", "a\nb", "a\r\nb", "\n", 'quo"te', '"', "a,b", "back\\slash", "\\", "tab\tx", " space ", "é 日本", ""]
    texts = [c for c in CATALOG_COLUMNS if c != "product_id"]
    rows = [(i, *[odd[(i + k) % len(odd)] for k in range(len(texts))], NOW) for i in range(len(odd))]
    schema = "product_id bigint, " + ", ".join(f"{c} string" for c in texts) + ", post_date timestamp_ntz"
    frame = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "catalog")
    write_catalog_csv(frame, path)
    assert values(read_catalog_csv(spark, path)) == values(frame.select(*CATALOG_COLUMNS))
    write_catalog_csv(frame.withColumn("slug", F.lit("x")), path, rows_per_file=4)
    assert read_catalog_csv(spark, path).count() == len(odd)
