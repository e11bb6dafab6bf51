from pyspark.sql import functions as F

from tidemark import schemas, seeds
from tidemark.operators import dimensions as D
from tidemark.sources.tables import load_tickers, load_topics


def test_seed_twice_changes_nothing(spark):
    topics = seeds.topics(spark)
    merged = D.merge_topics(topics, topics)
    assert sorted(map(str, merged.collect())) == sorted(map(str, topics.collect()))
    countries = seeds.countries(spark)
    assert D.add_countries(countries, countries.withColumn("name", F.lit("x"))).exceptAll(countries).isEmpty()


def test_topics(rows):
    stored = rows([("war", "War", True, ["war"])], schemas.TOPIC)
    merged = D.merge_topics(stored, rows([("war", "Conflict", False, []), ("new", "New", True, ["n"])], schemas.TOPIC))
    assert sorted(map(tuple, merged.collect())) == [("new", "New", True, ["n"]), ("war", "Conflict", False, [])]
    swapped = D.replace_keywords(merged, rows([("war", ["guerre"]), ("none", ["x"])], "key string, keywords array<string>"))
    assert {r.key: r.keywords for r in swapped.collect()} == {"new": ["n"], "war": ["guerre"]}


def test_tickers(spark, rows):
    stored = seeds.tickers(spark).withColumn("last_updated", F.lit("2024-01-01").cast("timestamp"))
    update = rows([(None, "AAPL", "Apple", "X", "USD", None, "UTC", None)], schemas.TICKER)
    merged = D.merge_tickers(stored, update, "2024-02-01")
    row = merged.where("symbol = 'AAPL'").first()
    assert (row.id, row.name, row.tz, row.iso2, str(row.last_updated)) == (1, "Apple", "UTC", "US", "2024-02-01 00:00:00")
    assert merged.count() == 30
    moved = D.assign_countries(merged, rows([("AAPL", "QQ")], "symbol string, iso2 string"))
    assert [r.symbol for r in D.unknown_countries(moved, seeds.countries(spark)).collect()] == ["AAPL"]


def test_load_from_files(spark, rows, tmp_path):
    seeds.topics(spark).write.parquet(str(tmp_path / "topics"))
    assert load_topics(spark, path=str(tmp_path / "topics")).count() == 10
    rows([(2, "B", None), (1, "A", "Asia/Tokyo")], "id int, symbol string, tz string").write.json(str(tmp_path / "t"))
    loaded = load_tickers(spark, format="json", path=str(tmp_path / "t"))
    assert [(r.symbol, r.tz) for r in loaded.collect()] == [("A", "Asia/Tokyo"), ("B", "UTC")]
