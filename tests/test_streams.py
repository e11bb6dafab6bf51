"""Streams give what the batch functions give, also when batches are replayed."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import geo
from tidemark.plans import signals, views
from tidemark.sources.edits import kafka_options, parse_edits, read_edit_stream, read_edits
from tidemark.sources.levels import Levels
from tidemark.sources.sinks import as_messages, edit_store_schema, merge_batches, read_stored, write_edits
from tidemark.streaming import edits as E
from tidemark.streaming import finals as N
from tidemark.streaming import prices as P
from tidemark.streaming import windows as W


def _event(number, country="US", title="war bank"):
    dt = f"2024-01-{1 + number % 3:02d}T10:{number % 60:02d}:00Z"
    return {"meta": {"id": str(number), "dt": dt}, "title": title, "page_country_code": country}


def _write_lines(folder, name, events):
    folder.mkdir(exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def topics(rows):
    return lambda: rows([("war", "War", True, ["war"]), ("finance", "Finance", True, ["bank"])], schemas.TOPIC)


def _stored_ids(spark, path):
    return sorted(int(r.meta_id) for r in spark.read.parquet(path).collect())


def test_edits_are_stored_once(spark, tmp_path, topics):
    feed, stored = tmp_path / "feed", str(tmp_path / "stored")

    seen = []

    def run(checkpoint, **options):
        stream = read_edit_stream(spark, "text", str(feed), maxFilesPerTrigger="1")
        report = lambda name, counts: seen.append(counts)
        E.store_edits(stream, topics, stored, str(tmp_path / checkpoint), report=report, **options).awaitTermination()

    _write_lines(feed, "a", [_event(n) for n in range(30)] + [_event(n) for n in range(10)])
    _write_lines(feed, "b", [_event(n) for n in range(20, 50)])
    _write_lines(feed, "c", [_event(98, None), _event(99, title="award"), '{"title": ', {"title": "war", "page_country_code": "US"}])
    run("one")
    assert _stored_ids(spark, stored) == list(range(50))
    assert sorted(c["seen"] for c in seen) == [4, 30, 40]
    assert [c for c in seen if c["seen"] == 4] == [{"seen": 4, "no_id": 2, "no_time": 2, "no_country": 2}]
    _write_lines(feed, "d", [_event(n) for n in range(45, 55)])
    run("one")
    assert _stored_ids(spark, stored) == list(range(55))
    # A new checkpoint reads everything again.
    run("two")
    run("three", same_date=True)
    assert _stored_ids(spark, stored) == list(range(55))


def test_replayed_batch_replaces_its_own_rows(spark, rows, tmp_path):
    path = str(tmp_path / "stored")

    def edits(numbers):
        return rows([(str(n), f"r{n}") for n in numbers], "meta_id string, raw string").withColumn(
            "dt", F.when(F.col("meta_id") != "7", F.lit("2024-01-01").cast("timestamp"))
        )

    for _ in range(2):
        write_edits(edits(range(5)), path, "q_0")
    write_edits(edits(range(3, 8)), path, "q_1")
    write_edits(edits(range(5)), path, "q_0")
    write_edits(edits(range(6, 8)), path, "q_2")
    assert _stored_ids(spark, path) == list(range(8))


def test_replay_and_redelivery(spark, rows, tmp_path):
    path = str(tmp_path / "stored")

    def edits(data):
        return rows(data, "meta_id string, raw string, day string").withColumn("dt", F.col("day").cast("timestamp")).drop("day")

    write_edits(edits([("p", "r", "2024-01-01"), ("q", "r", "2024-01-02")]), path, "a_0")
    # A replay under another dictionary keeps fewer rows: the others go.
    write_edits(edits([("p", "r", "2024-01-01")]), path, "a_0")
    schema = edit_store_schema(edits([]))
    assert [r.meta_id for r in read_stored(spark, path, schema).collect()] == ["p"]
    # An id that comes again under another date, or a stray one, is stored once.
    write_edits(edits([("p", "r", "2024-01-03"), ("x", "r", "1970-01-01"), ("y", "r", None)]), path, "a_1")
    write_edits(edits([("y", "r", "2100-01-01"), ("z", "r", "2024-01-01")]), path, "a_2")
    assert sorted(r.meta_id for r in read_stored(spark, path, schema).collect()) == ["p", "x", "y", "z"]
    merge_batches(spark, path, schema, str(tmp_path / "merged"))
    write_edits(edits([("z", "r", "2024-01-01"), ("w", "r", "2024-01-01")]), str(tmp_path / "merged"), "b_0")
    merged = read_stored(spark, str(tmp_path / "merged"), schema)
    assert sorted(r.meta_id for r in merged.collect()) == ["p", "w", "x", "y", "z"]


def test_enriched_messages(spark, rows, tmp_path):
    claims = rows([("p", "P17", 0, "Q30", None), ("Q30", "P297", 0, None, "US")], schemas.CLAIM)
    countries = geo.entity_countries(claims)
    page = geo.place_pages(rows([("en.wikipedia.org", "T", "p")], "server_name string, title string, qid string"), countries)
    link = geo.place_pages(rows([], "site string, title string, qid string"), countries)
    feed = tmp_path / "feed"
    _write_lines(feed, "a", [{"server_name": "en.wikipedia.org", "title": "T"}, {"server_name": "x.org"}, "{"])
    stream = read_edit_stream(spark, "text", str(feed))
    counts = {}
    E.enrich_stream(
        stream, lambda: (page, link), str(tmp_path / "out"), str(tmp_path / "ck"), lambda name, c: counts.update(c)
    ).awaitTermination()
    assert counts == {"seen": 2, "kept": 1}
    sent = parse_edits(spark.read.parquet(str(tmp_path / "out"))).collect()
    assert [(r.title, r.page_country_code, r.geo_method, r.geo_confidence) for r in sent] == [("T", "US", "P17", 100)]


def test_batch_and_stream_sources_agree(spark, tmp_path):
    feed = tmp_path / "feed"
    _write_lines(feed, "a", [_event(1), _event(2)])
    assert read_edits(spark, "text", str(feed)).count() == 2
    options = kafka_options("host:9092", "edits", "earliest", group="g")
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "false")


def test_messages_round_trip(rows):
    df = rows([("k", 1, None)], "title string, namespace int, comment string")
    sent = as_messages(df, "title")
    assert sent.columns == ["key", "value"]
    assert parse_edits(sent).select("title", "namespace", "comment").first() == ("k", 1, None)


BAR = "ticker_id int, ts_utc timestamp, close double, id int"


def test_previous_close_over_batches(spark, rows, tmp_path):
    data = [(n % 3, 1_700_000_000 + 60 * n, float(n), n) for n in range(60)]
    source = tmp_path / "bars"
    for part in range(4):
        chunk = rows(data[part * 15 : part * 15 + 15], "ticker_id int, s bigint, close double, id int")
        chunk.select("ticker_id", F.timestamp_seconds("s").alias("ts_utc"), "close", "id").coalesce(1).write.parquet(
            str(source / f"{part}")
        )
        for file in (source / f"{part}").glob("*.parquet"):
            file.rename(source / f"{part}.parquet")

    def stream():
        return spark.readStream.schema(BAR).option("maxFilesPerTrigger", "1").parquet(str(source / "*.parquet"))

    query = P.store_returns(stream(), str(tmp_path / "out"), str(tmp_path / "ck"), ["id"])
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "returns"))
    assert got.select("batch_id").distinct().count() == 4
    assert {(r.id, r.prev_close, r.late) for r in got.collect()} == {
        (n, float(n - 3) if n >= 3 else None, False) for n in range(60)
    }


def test_late_bar_is_marked(rows):
    def bars(data):
        return rows([(1, s, float(s), s) for s in data], "ticker_id int, s bigint, close double, id int").select(
            "ticker_id", F.timestamp_seconds("s").alias("ts_utc"), "close", "id"
        )

    returns = P.batch_returns(bars([5, 20, 30]), bars([10]), ["id"])
    assert {(r.id, r.prev_close, r.late) for r in returns.collect()} == {
        (5, None, True), (20, 10.0, False), (30, 20.0, False)
    }


ORDERS = {"one batch": None, "in order": [0, 1, 2, 3], "shuffled": [2, 0, 3, 1]}


def _files(spark, frame, folder, key, order):
    """``frame`` as four files that a stream takes one by one in the given order, or all at once."""
    for place, part in enumerate(order or [0, 1, 2, 3]):
        frame.where(F.floor(F.col(key) / 100) == part).drop(key).coalesce(1).write.parquet(str(folder / f"p{place}"))
        (file,) = (folder / f"p{place}").glob("*.parquet")
        file.rename(folder / f"{place}.parquet")
        # Files are taken by their time of change.
        os.utime(folder / f"{place}.parquet", (1_600_000_000 + place, 1_600_000_000 + place))
    schema = frame.drop(key).schema
    paths = str(folder / "*.parquet")
    return spark.read.schema(schema).parquet(paths), spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", "1" if order else "10"
    ).parquet(paths)


@pytest.fixture(params=ORDERS)
def edit_files(request, spark, rows, tmp_path):
    data = [(n, 1_700_000_000 + 40 * n, "US" if n % 3 else "DE", ["a", "b"] if n % 5 == 0 else ["a"]) for n in range(400)]
    data += [(n, 1_700_000_000 + 40 * n, "US", ["b"]) for n in range(150, 160) for _ in range(9)]
    frame = rows(data, "n int, s bigint, page_country_code string, topics array<string>").select(
        F.timestamp_seconds("s").alias("dt"), "page_country_code", "topics", "n"
    )
    return *_files(spark, frame, tmp_path / "edits", "n", ORDERS[request.param]), request.param


def _set(df, columns=None):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*(columns or df.columns)).collect()}


def test_window_counts(spark, edit_files, tmp_path):
    batch, stream, order = edit_files
    W.store_sums(stream, str(tmp_path / "o"), str(tmp_path / "ck"), W.country_counts).awaitTermination()
    wanted = views.country_minute(batch)
    assert _set(W.stored_counts(spark, str(tmp_path / "o")), wanted.columns) == _set(wanted)
    progress = spark.read.parquet(str(tmp_path / "o" / "progress"))
    seen, late = progress.agg(F.sum("seen"), F.sum("late")).first()
    assert seen == 490 and (late > 0) == (order == "shuffled")


def test_alerts(spark, edit_files, tmp_path):
    batch, stream, _ = edit_files
    W.store_alerts(stream, str(tmp_path / "o"), str(tmp_path / "ck"), 600, 4).awaitTermination()
    steps = signals.surge_alerts(signals.topic_surges(signals.topic_counts(batch, 600), 4), 0.5)
    assert _set(W.stored_alerts(spark, str(tmp_path / "o"), 0.5), steps.columns) == _set(steps) != set()


def test_joined_windows(spark, edit_files, rows, tmp_path):
    batch, stream, order = edit_files
    frame = rows(
        [(n, "US", 1_700_000_000 + 40 * n, float(n + 1), float(n)) for n in range(0, 400, 2)],
        "n int, iso2 string, s bigint, close double, prev_close double",
    ).select("n", "iso2", F.timestamp_seconds("s").alias("ts_minute_utc"), "close", "prev_close")
    returns, moves = _files(spark, frame, tmp_path / "returns", "n", ORDERS[order])
    for name, source, sums, ts in (("e", stream, W.country_counts, "dt"), ("m", moves, W.country_moves, "ts_minute_utc")):
        W.store_sums(source, str(tmp_path / name), str(tmp_path / f"{name}_ck"), sums, ts).awaitTermination()
    got = W.joined_signals(spark, str(tmp_path / "e"), str(tmp_path / "m"))
    both = views.joined_signals(views.country_return_minute(returns, "minute"), views.country_minute(batch))
    assert _set(got) == _set(both, got.columns)


@pytest.mark.parametrize("order", ORDERS)
def test_previous_closes_in_any_order(spark, rows, tmp_path, order):
    data = [(n, n % 3, 1_700_000_000 + 60 * (n // 4), float(n), n) for n in range(400)]
    frame = rows(data, "n int, ticker_id int, s bigint, close double, id int").withColumn("ts_utc", F.timestamp_seconds("s")).drop("s")
    batch, stream = _files(spark, frame, tmp_path / "bars", "n", ORDERS[order])
    P.store_returns(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["id"]).awaitTermination()
    got = P.stored_returns(spark, str(tmp_path / "out"), ["id"])
    assert _set(got, ["id", "prev_close"]) == {(n, float(n - 3) if n >= 3 else None) for n in range(400)}


def test_windows_of_panes(rows, edit_files, capsys):
    batch, _, order = edit_files
    if order != "in order":
        return
    for length, slide in ((1800, 60), (1800, 600), (1500, 600), (60, 60), (90, 60)):
        pane = math.gcd(length, slide)
        got = W.rolling_counts(W.country_counts(batch, f"{pane} seconds"), length, slide)
        assert _set(got) == _set(W.country_counts(batch, f"{length} seconds", f"{slide} seconds"), got.columns)
    got.explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0].splitlines()
    # From the top: the windows' sums, their copies, the panes' sums, and no copies of edits below.
    kinds = [k for line in plan for k in ("Aggregate", "Generate", "Expand") if line.strip(" :+-").startswith(k)]
    assert kinds == ["Aggregate", "Generate", "Aggregate"]


def test_sums_of_many_batches_are_few_folders(spark, rows, tmp_path):
    """A replay after the sums were stored changes nothing; every batch opens few runs."""
    home = str(tmp_path / "o")
    for number in [*range(20), 19]:
        dt = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * (number % 4)))
        batch = rows([("US", ["a"])], "page_country_code string, topics array<string>").withColumn("dt", dt).coalesce(1)
        W._store_sums(batch, f"q_{number:012d}", home, W.country_counts, list(W.WINDOW_KEYS), "dt", "1 hour")
    assert sorted(r.event_count for r in W.stored_counts(spark, home).collect()) == [5, 5, 5, 5]
    assert len(Levels(spark, f"{home}/sums").runs()) <= 9
    assert len({f.rsplit("/", 2)[1] for f in W.stored_sums(spark, home, list(W.WINDOW_KEYS)).inputFiles()}) <= 9


def test_finals_and_corrections(spark, edit_files, tmp_path):
    """Late rows take back a final row and add the right one; open windows are in the state."""
    batch, stream, order = edit_files
    home, ck, sums = str(tmp_path / "o"), str(tmp_path / "ck"), str(tmp_path / "s")
    N.store_finals(stream, home, ck, "1 minute").awaitTermination()
    W.store_sums(stream, sums, str(tmp_path / "sck"), W.country_counts).awaitTermination()
    wanted = views.country_minute(batch)
    final = spark.read.parquet(f"{home}/final")
    assert final.count() == final.select(*W.WINDOW_KEYS).distinct().count() > 0
    changes = N.store_corrections(spark, home, sums, ck, "first_0")
    signs = {r.sign for r in changes.collect()}
    assert (1 in signs) == (order == "shuffled")
    rows = N.all_counts(spark, home, ck)
    assert rows.where("NOT final").count() > 0
    assert _set(rows.drop("final"), wanted.columns) == _set(wanted)
    # Nothing came since: no correction is made twice.
    assert N.store_corrections(spark, home, sums, ck, "second_0").count() == 0


def test_stream_join(spark, edit_files, rows, tmp_path):
    batch, stream, order = edit_files
    frame = rows(
        [(n, "US" if n % 4 else None, 1_700_000_000 + 40 * n, float(n + 1), float(n)) for n in range(0, 400, 2)],
        "n int, iso2 string, s bigint, close double, prev_close double",
    ).select("n", "iso2", F.timestamp_seconds("s").alias("ts_minute_utc"), "close", "prev_close")
    returns, moves = _files(spark, frame, tmp_path / "returns", "n", ORDERS[order])
    home, ck = str(tmp_path / "o"), str(tmp_path / "ck")
    N.store_joined(stream, moves, home, ck, "1 day" if order == "shuffled" else "5 minutes").awaitTermination()
    both = views.joined_signals(views.country_return_minute(returns, "minute"), views.country_minute(batch))
    got = N.stored_joined(spark, home, ck)
    assert got.count() == both.count() and _set(got, both.columns) == _set(both)
    if order == "in order":
        assert spark.read.parquet(f"{home}/joined").count() > 100
