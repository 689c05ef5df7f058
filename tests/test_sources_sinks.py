"""Reading back what is written, listings, clean-up, the pluggable source, the stream."""

import json
import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docketloom.operators import purge, store
from docketloom.schema import CASE_DDL
from docketloom.sources import config, readers, sinks
from docketloom.sources.pluggable import CaseSource, load_class
from docketloom.streaming import ingest
from docketloom.streaming.ingest import follow_cases

TEXTS = ["spécial chars: éñü 测试", 'quotes "x", commas', "two\nlines", None]


@pytest.fixture(scope="module")
def nested(spark):
    cases = spark.createDataFrame([(f"IMM-{i}-2{3 + i % 2}", t, date(2023, 6, 15), "Toronto", datetime(2023, 6, 15, 10)) for i, t in enumerate(TEXTS, 1)], "case_id string, style_of_cause string, filing_date date, office string, scraped_at timestamp_ntz")
    entries = spark.createDataFrame([(None, "IMM-1-24", 1, date(2025, 1, 2), "TestOffice", "Test entry")], "id int, case_id string, doc_id int, entry_date date, entry_office string, summary string")
    return store.nest(cases, entries)


def test_json_array(spark, nested, tmp_path):
    sinks.write_json_array(sinks.case_dict(nested), str(tmp_path / "a"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    got = {c["case_id"]: c for c in json.loads(text)}
    assert len(got) == 4 and got["IMM-1-24"]["case_number"] == "IMM-1-24" and got["IMM-1-24"]["title"] == TEXTS[0] and got["IMM-1-24"]["date"] == "2023-06-15"
    assert len(got["IMM-1-24"]["docket_entries"]) == 1 and got["IMM-1-24"]["docket_entries"][0]["doc_id"] == 1 and got["IMM-4-23"]["docket_entries"] == []
    assert got["IMM-4-23"]["title"] is None and "url" in got["IMM-4-23"]
    back = readers.read_case_array(spark, str(tmp_path / "a"))
    assert {r["style_of_cause"] for r in back.collect()} == set(TEXTS)
    with pytest.raises(ValueError, match="nothing"):
        sinks.write_json(nested.where("false"), str(tmp_path / "b"))
    with pytest.raises(Exception, match="more than 2"):
        sinks.write_json_array(sinks.case_dict(nested), str(tmp_path / "c"), most=2)


def test_case_files_by_year(spark, nested, tmp_path):
    for _ in range(2):
        sinks.write_case_files(nested, str(tmp_path / "json"), F.to_date(F.lit("2030-01-01")))
    assert sorted(p.name for p in (tmp_path / "json").glob("year=*")) == ["year=2023", "year=2024"]
    back = readers.read_case_files(spark, str(tmp_path / "json"))
    assert back.count() == 4 and back.where("size(docket_entries) = 1").first()["year"] == 2024


def test_exporting_one_year_keeps_the_others(spark, nested, tmp_path):
    for year in (23, 24):
        sinks.write_case_files(nested.where(F.col("case_id").endswith(f"-{year}")), str(tmp_path / "json"), F.to_date(F.lit("2030-01-01")))
    assert {(r["year"], r["case_id"]) for r in readers.read_case_files(spark, str(tmp_path / "json")).collect()} == {(2024, "IMM-1-24"), (2023, "IMM-2-23"), (2024, "IMM-3-24"), (2023, "IMM-4-23")}


def test_a_file_for_each_case(spark, nested, tmp_path):
    today, root = F.to_date(F.lit("2030-01-01")), tmp_path / "json"
    for _ in range(2):
        assert sinks.write_each_case(nested, str(root), today) == 4
    names = ["2023/IMM-2-23-20230101.json", "2023/IMM-4-23-20230101.json", "2024/IMM-1-24-20240101.json", "2024/IMM-3-24-20240101.json"]
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()) == names
    got = json.loads((root / names[2]).read_text())
    assert got["case_id"] == "IMM-1-24" and got["style_of_cause"] == TEXTS[0] and got["docket_entries"][0]["doc_id"] == 1
    for k in (1, 2):
        assert sinks.write_each_case(nested.where("case_id = 'IMM-1-24'"), str(root), today, suffixes=True) == 1
        assert (root / f"2024/IMM-1-24-20240101-{k}.json").exists()


def test_csv(spark, nested, tmp_path):
    row = sinks.csv_row(nested)
    assert row.columns == ["case_id", "case_number", "title", "court", "date", "html_content", "scraped_at"]
    sinks.write_clean_csv(row, store.unnest(nested).drop("position"), str(tmp_path))
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(f"{tmp_path}/cases")
    assert {r["title"] or "" for r in back.collect()} == {t or "" for t in TEXTS}
    assert spark.read.option("header", True).csv(f"{tmp_path}/docket_entries").count() == 1


def test_payload(nested):
    got = sinks.payload(nested, F.lit("2025-01-01 00:00:00").cast("timestamp")).first().asDict()
    assert set(got) == {"case", "docket_entries", "scraped_at"}


def test_url_list(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("# comment\n\n  https://a  \n #kept because it starts with a space\nhttps://b\n")
    assert [r["url"] for r in readers.read_url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["https://a", "#kept because it starts with a space", "https://b"]


def test_year_files(spark, tmp_path):
    for name in ("output/1999/a.json", "output/1999/b.json", "output/json/1999/c.txt", "output/2000/d.json", "output/x.json", "logs/modal_IMM-1-1999_1.html", "logs/modal_IMM-2-1999_2.HTM", "logs/other.txt", "logs/sub/1999.html"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    names = lambda df: sorted(Path(r["path"]).name for r in df.collect())
    out, logs = readers.year_artifacts(spark, f"{tmp_path}/output", 1999), readers.year_html_logs(spark, f"{tmp_path}/logs", 1999)
    assert names(out) == ["a.json", "b.json", "c.txt"] and names(logs) == ["modal_IMM-1-1999_1.html", "modal_IMM-2-1999_2.HTM"]
    assert names(readers.export_files(spark, f"{tmp_path}/output")) == ["x.json"]
    assert sinks.backup_year(spark, f"{tmp_path}/output", 1999, f"{tmp_path}/backup") == 3 and (tmp_path / "backup/1999/a.json").exists()
    assert sinks.remove_files(out.union(logs)) == {"removed": 5, "skipped": 0}
    assert (tmp_path / "logs/other.txt").exists() and not (tmp_path / "output/1999/a.json").exists()


def test_keep_the_newest(spark):
    files = spark.createDataFrame([(f"f{i}", datetime(2024, 1, 1 + i % 5)) for i in range(10)], "path string, modificationTime timestamp")
    assert sinks.beyond_newest(files, 4).count() == 6


def test_swap_replaces_what_it_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.swap(spark.range(3), path)
    sinks.swap(spark.read.parquet(path).where("id > 0"), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2] and len(list(tmp_path.iterdir())) == 1


@pytest.mark.parametrize("step", [1, 2])
def test_swap_that_fails_keeps_the_table(spark, tmp_path, monkeypatch, step):
    path, calls, move = str(tmp_path / "t"), [], sinks._move
    sinks.swap(spark.range(3), path)

    def failing(fs, source, target):
        calls.append(1)
        if len(calls) == step:
            raise OSError("no")
        move(fs, source, target)

    monkeypatch.setattr(sinks, "_move", failing)
    with pytest.raises(OSError, match="no"):
        sinks.swap(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3 and len(list(tmp_path.iterdir())) == 1


def test_a_table_moved_aside_is_put_back(spark, tmp_path):
    path = tmp_path / "t"
    sinks.swap(spark.range(3), str(path))
    path.rename(tmp_path / "t.old-1")
    sinks.recover(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 3
    (tmp_path / "t.old-2").mkdir()
    sinks.recover(spark, str(path))
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def purge_setting(spark, root):
    cases = [("IMM-1-24", date(2024, 1, 1)), ("IMM-2-23", date(2023, 1, 1))]
    spark.createDataFrame(cases, "case_id string, filing_date date").write.parquet(f"{root}/cases")
    spark.createDataFrame([(c, 1) for c, _ in cases], "case_id string, doc_id int").write.parquet(f"{root}/entries")
    for name in ("out/2024/a.json", "out/2024/x/b.json", "out/json/2024/c.json", "out/2023/d.json", "logs/modal_2024.html"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x")
    return {"cases_path": f"{root}/cases", "entries_path": f"{root}/entries", "output_root": f"{root}/out", "logs_root": f"{root}/logs", "audit_path": f"{root}/audit.json"}


def test_purge_runs(spark, tmp_path):
    paths = purge_setting(spark, tmp_path)
    dry = purge.execute(spark, 2024, **paths)
    assert dry["cases_deleted"] == 1 and (tmp_path / "out/2024/a.json").exists() and spark.read.parquet(paths["cases_path"]).count() == 2
    done = purge.execute(spark, 2024, **paths, backup=str(tmp_path / "backup"), dry_run=False)
    assert (done["cases_deleted"], done["entries_deleted"], done["output_removed"], done["modal_html_removed"]["removed"]) == (1, 1, {"removed_files": 3, "removed_dirs": 1}, 1)
    assert [r[0] for r in spark.read.parquet(paths["cases_path"]).select("case_id").collect()] == [r[0] for r in spark.read.parquet(paths["entries_path"]).select("case_id").collect()] == ["IMM-2-23"]
    assert (tmp_path / "out/2023/d.json").exists() and not (tmp_path / "out/2024").exists() and (tmp_path / "backup/2024/a.json").exists()
    assert json.loads((tmp_path / "audit.json").read_text())["backed_up"] == done["backed_up"] >= 2


@pytest.mark.parametrize(("options", "kept"), [({"strict": True}, True), ({"strict": True, "force_files": True}, False), ({}, False)])
def test_purge_without_tables(spark, tmp_path, options, kept):
    paths = purge_setting(spark, tmp_path) | {"cases_path": f"{tmp_path}/none"}
    out = purge.execute(spark, 2024, **paths, dry_run=False, **options)
    assert out["errors"] and (tmp_path / "out/2024/a.json").exists() == kept
    with pytest.raises(ValueError, match="exclude"):
        purge.execute(spark, 2024, **paths, files_only=True, db_only=True)


SERVICE = '''
class Fake:
    def fetch_case_and_docket(self, number, flag):
        return ({"case_id": number, "office": None}, [{"doc_id": 1}]) if number != "IMM-2-25" else (None, [])
'''


def test_pluggable_source(spark, tmp_path):
    (tmp_path / "fake.py").write_text(SERVICE)
    assert load_class("collections.Counter").__name__ == "Counter"
    spark.dataSource.register(CaseSource)
    got = spark.read.format("cases").option("service", f"{tmp_path}/fake.py:Fake").option("cases", "IMM-1-25,IMM-2-25,IMM-3-25").load().orderBy("case_number").collect()
    assert [(r["case_number"], r["found"], len(r["entries"])) for r in got] == [("IMM-1-25", True, 1), ("IMM-2-25", False, 0), ("IMM-3-25", True, 1)]


def test_follow_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store_path = str(tmp_path / "store")

    def put(name, *cases):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"case_id": c, "office": o, "scraped_at": t}) for c, o, t in cases))
        stream = follow_cases(spark, str(tmp_path / "in"), store_path).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        stream.awaitTermination()

    put("1.json", ("a", "x", "2024-01-01T00:00:00"), ("b", "y", "2024-01-01T00:00:00"))
    put("2.json", ("b", "z", "2024-02-01T00:00:00"), ("b", "old", "2024-01-15T00:00:00"))
    assert stored(spark, store_path) == [("a", "x"), ("b", "z")]
    put("3.json", ("c", "w", None), (None, "no number", None), ("a", "x2", "2023-01-01T00:00:00"))
    assert stored(spark, store_path) == [("a", "x2"), ("b", "z"), ("c", "w")]


def stored(spark, path):
    return sorted((r["case_id"], r["office"]) for r in ingest.CaseStore(spark, path).cases().collect())


def a_batch(spark, *cases):
    return spark.createDataFrame([(c, o) for c, o in cases], "case_id string, office string").select("*", *[F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in CASE_DDL.split(", ")) if n not in ("case_id", "office")]).select([c.split()[0] for c in CASE_DDL.split(", ")])


@pytest.mark.parametrize(("fold", "most"), [(0.0, 64), (1e9, 2), (1e9, 64)])
def test_a_store_of_batches(spark, tmp_path, monkeypatch, fold, most):
    """Whether batches are folded at once, joined in the log or left alone, the same cases are read."""
    monkeypatch.setattr(ingest, "FOLD", fold)
    monkeypatch.setattr(ingest, "MOST_FOLDERS", most)
    store, want = ingest.CaseStore(spark, str(tmp_path)), {}
    assert stored(spark, str(tmp_path)) == []
    for k in range(5):
        mine = {f"c{k}": f"o{k}", "same": f"o{k}", f"c{k // 2}": f"late{k}"}
        store.put(a_batch(spark, *mine.items()), ["office"])
        want |= mine
        assert stored(spark, str(tmp_path)) == sorted(want.items())
    store.put(a_batch(spark, *mine.items()), ["office"])  # again
    store.put(a_batch(spark), ["office"])
    assert stored(spark, str(tmp_path)) == sorted(want.items())
    left = len(list((tmp_path / "log").iterdir()))
    assert left == 7 if most == 64 and fold > 1 else left <= 3


def test_what_a_cut_off_fold_leaves_changes_nothing(spark, tmp_path, monkeypatch):
    store = ingest.CaseStore(spark, str(tmp_path))
    monkeypatch.setattr(ingest, "FOLD", 1e9)
    for office in ("old", "new"):
        store.put(a_batch(spark, ("a", office)), ["office"])
    monkeypatch.setattr(store, "_clear", lambda folders: shutil.rmtree(tmp_path / "log" / f"n{1:012d}"))
    store.fold()  # only the newer batch is cleared
    (tmp_path / "log" / f"n{0:012d}.new-x").mkdir()
    assert stored(spark, str(tmp_path)) == [("a", "new")]


def test_database(spark):
    """A database reads as one table, or in parts by a column; filters reach it."""
    url = "jdbc:derby:memory:cases;create=true"
    spark.range(100).selectExpr("cast(id as int) as N", "concat('IMM-', id, '-24') as CASE_ID").write.format("jdbc").options(url=url, dbtable="stored").mode("overwrite").save()
    query = "SELECT n, case_id FROM stored WHERE n >= 10"
    assert readers.read_database(spark, url, query).count() == 90
    parts = readers.read_database(spark, url, query, partitionColumn="N", lowerBound="0", upperBound="100", numPartitions="4")
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 90
    one = parts.where("N = 42")
    assert [r["CASE_ID"] for r in one.collect()] == ["IMM-42-24"] and "PushedFilters: [*IsNotNull(N), *EqualTo(N,42)]" in one._jdf.queryExecution().toString()


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "private.toml").write_text("[app]\nmin_delay = 0\n")
    (tmp_path / "public.toml").write_text("[app]\nmin_delay = 5.0\nmax_retries = 9\n")
    monkeypatch.setenv("DOCKETLOOM_MAX_RETRIES", "4")
    got = config.settings(str(tmp_path / "private.toml"), str(tmp_path / "public.toml"), emergency_stop=3)
    assert (got["min_delay"], got["max_retries"], got["emergency_stop"], got["write_audit"]) == (0, 9, 3, False)
