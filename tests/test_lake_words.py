"""What a delivery no longer scans twice or shuffles."""

from orderlake.contracts import LINE_KEY, LINE_SIGNATURE
from orderlake.operators import duplicates, merge
from orderlake.operators.plan import plan_text
from orderlake.plans import lake as lakes
from orderlake.plans import lines as line_plans
from orderlake.plans.lines import LineLake
from orderlake.sources.tables import Stage
from samples import lines, values
from test_copies import no_broadcast  # noqa: F401
from test_pipelines import D1, line_file


def test_rows_are_held_against_words_without_a_shuffle_whatever_is_small(spark, no_broadcast):  # noqa: F811
    stage = Stage(spark)
    rows = stage.keep(lines(spark, {}, {}, dict(order_id="2"), dict(region=None)), "rows")
    words = stage.keep(duplicates.suspect_words(duplicates.suspect_hashes(rows, LINE_SIGNATURE)), "words")
    told = duplicates.tell_suspects(rows, LINE_SIGNATURE, words)
    assert "Exchange hashpartitioning" not in plan_text(told, mode="simple")
    assert told.where("_is_suspect").count() == 2


def test_history_is_narrowed_to_keys_a_batch_may_bring(spark, tmp_path):
    lake = LineLake(spark, str(tmp_path / "lake"))
    history = merge.open_versions(lines(spark, *[dict(order_id=str(n)) for n in range(300)], dict(order_id=None)))
    batch = lines(spark, *[dict(order_id=str(n)) for n in range(280, 320)], dict(order_id=None))
    held = lake.met(history, batch.withColumn("line_item_seq", batch.line_item_seq.cast("bigint")), LINE_KEY, "lines")
    found = {row.order_id for row in held.collect()}
    assert held.columns == history.columns and {str(n) for n in range(280, 300)} <= found and len(found) < 30


def test_first_delivery_is_not_scanned_for_its_load_dates(spark, tmp_path, monkeypatch):
    def refused(*_):
        raise AssertionError("scanned")

    monkeypatch.setattr(line_plans, "values_of", refused)
    monkeypatch.setattr(lakes, "FIRST_ROWS", 3)
    days = ["2026-06-01"] * 4 + [" 2026-06-02 ", "no date", None, "2026-6-3", "2026-06-04", "2026-06-05", "2026-06-06"]
    lake = LineLake(spark, str(tmp_path / "lake"))
    lake.ingest(line_file(tmp_path / "d1.csv", *[dict(order_id=str(n), ingest_date=d) for n, d in enumerate(days)]), D1)
    assert values(lake.bronze.read(), "order_id", "ingest_date") == sorted(
        [(str(n), d) for n, d in enumerate(["2026-06-01"] * 4 + ["2026-06-02", None, None, "2026-06-03", "2026-06-04",
                                                                 "2026-06-05", "2026-06-06"])], key=repr)
