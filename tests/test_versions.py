"""Versions of landed entities: a stop at any moment leaves the old state or the new one."""

from __future__ import annotations

import json
import os

import pytest

from rallymart.plans import checks, layers, registry
from rallymart.sources import derived, landing, tables, versions

BUCKETS = landing.BUCKETS_SETTING


@pytest.fixture
def folder(spark, tmp_path):
    spark.conf.set(BUCKETS, "64")
    yield str(tmp_path)
    spark.conf.unset(BUCKETS)


def teams(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string")


def names(spark, folder, lines=True):
    return {r.id: r.name for r in landing.read_landed(spark, folder, "teams", lines=lines).collect()}


class Stopped(Exception):
    pass


def stop(*_, **__):
    raise Stopped


# What comes after one another in a write, and whether the new state counts once it is reached.
STEPS = [("_noted_schema", False), ("versions.add", False), ("Files.move", None), ("versions.discard_old", True)]


@pytest.mark.parametrize("began", ["nothing", "plain file", "versions"])
@pytest.mark.parametrize("step, done", STEPS)
def test_a_stop_leaves_the_old_or_the_new(spark, folder, tmp_path, monkeypatch, began, step, done):
    old = {}
    if began == "plain file":
        (tmp_path / "teams.json").write_text(json.dumps({"id": "1", "name": "a"}) + "\n")
        old = {"1": "a"}
    elif began == "versions":
        landing.upsert_landed(spark, folder, "teams", teams(spark, ("1", "a"), ("2", "b")))
        old = {"1": "a", "2": "b"}
    new = old | {"2": "c", "3": "d"}
    load = teams(spark, ("2", "c"), ("3", "d"))
    with monkeypatch.context() as patch:
        where, _, what = step.rpartition(".")
        patch.setattr({"": landing, "versions": versions, "Files": versions.Files}[where], what, stop)
        with pytest.raises(Stopped):
            landing.upsert_landed(spark, folder, "teams", load)
    if began != "nothing" or done:
        assert names(spark, folder) in ([new] if done else [old] if done is False else [old, new])
    # The same load afterwards ends well.
    landing.upsert_landed(spark, folder, "teams", load)
    assert names(spark, folder) == new
    assert landing.landed_entities(spark, folder) == ["teams"]


def test_a_commit_that_is_gone_is_noticed(spark, folder, tmp_path):
    landing.upsert_landed(spark, folder, "teams", teams(spark, ("1", "a"), ("2", "b")))
    for commit in (tmp_path / ".teams.versions" / "commits").iterdir():
        commit.unlink()
    with pytest.raises(ValueError, match="no commit"):
        landing.upsert_landed(spark, folder, "teams", teams(spark, ("3", "c")))
    with pytest.raises(ValueError, match="no commit"):
        landing.write_landed(teams(spark, ("3", "c")), folder, "teams")


def test_a_file_landed_later_is_noticed(spark, folder, tmp_path):
    landing.upsert_landed(spark, folder, "teams", teams(spark, ("1", "a")))
    later = tmp_path / "teams.json"
    later.write_text('{"id": "2"}\n')
    commit = max((tmp_path / ".teams.versions" / "commits").glob("0*"))
    os.utime(later, (commit.stat().st_mtime + 60,) * 2)
    with pytest.raises(ValueError, match="landed after"):
        names(spark, folder)


def test_a_commit_is_never_overwritten(spark, folder):
    landing.write_landed(teams(spark, ("1", "a")), folder, "teams")
    base = versions.base_of(folder, "teams")
    last = versions.latest(spark, base)
    with pytest.raises(OSError, match="could not be moved"):
        versions.add(spark, base, last)


def test_a_small_load_touches_few_files(spark, folder, tmp_path):
    rows = [(str(i), f"team {i}") for i in range(400)]
    landing.write_landed(teams(spark, *rows), folder, "teams")
    base = versions.base_of(folder, "teams")
    before = versions.latest(spark, base).folders
    landing.upsert_landed(spark, folder, "teams", teams(spark, ("7", "new"), ("8", "new"), ("x", "new"), ("9", "new")))
    after = versions.latest(spark, base).folders
    touched = [b for b in after if after[b] != before.get(b)]
    assert len(before) > 50 and len(touched) <= 4 < 0.1 * len(before)
    assert names(spark, folder) == dict(rows) | {"7": "new", "8": "new", "9": "new", "x": "new"}
    # An empty load changes nothing.
    landing.upsert_landed(spark, folder, "teams", teams(spark).limit(0))
    assert versions.latest(spark, base).folders == after


def test_old_versions_go_and_the_last_ones_stay(spark, folder, tmp_path):
    for i in range(5):
        landing.upsert_landed(spark, folder, "teams", teams(spark, ("1", f"a{i}"), (f"b{i}", "b")))
    base = tmp_path / ".teams.versions"
    assert len(list((base / "commits").glob("0*"))) == versions.KEPT
    named = {f for n in (base / "commits").glob("0*") for f in json.loads(n.read_text())["folders"].values()}
    held = {str(p.relative_to(base)) for p in base.glob("v-*/*=*")}
    assert held == named
    assert names(spark, folder) == {"1": "a4", **{f"b{i}": "b" for i in range(5)}}


def test_fields_that_come_later_and_types(spark, folder):
    first = spark.sql("SELECT '1' AS id, CAST(NULL AS STRING) AS name, named_struct('a', 1) AS s")
    landing.upsert_landed(spark, folder, "teams", first)
    second = spark.sql("SELECT '2' AS id, 'n' AS name, named_struct('a', 2, 'b', 'x') AS s, DATE'2020-01-02' AS day")
    landing.upsert_landed(spark, folder, "teams", second)
    found = {r.id: r for r in landing.read_landed(spark, folder, "teams").collect()}
    assert found["1"].s.a == 1 and found["1"].s.b is None and found["1"].day is None
    assert (found["2"].s.b, found["2"].day) == ("x", "2020-01-02")
    landing.write_landed(first.limit(0), folder, "teams")
    assert landing.read_landed(spark, folder, "teams").count() == 0


def test_bronze_reads_versions(spark, folder):
    landing.upsert_landed(spark, folder, "teams", teams(spark, ("1", "a"), ("2", "b")))
    assert layers.run_bronze(spark, folder, f"{folder}/bronze") == {"teams": 2}


def _page(folder, name, offset, ids):
    (folder / name).write_text(json.dumps({"offset": offset, "data": [{"id": i, "name": "n"} for i in ids]}))


def test_only_new_files_are_loaded(spark, folder, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    _page(pages, "a.json", 0, ["1", "2"])

    def load():
        return landing.load_new_pages(spark, str(pages), folder, "teams", f"{folder}/lake")

    assert [load(), load()] == [1, 0]
    _page(pages, "b.json", 2, ["3"])
    assert [load(), load()] == [1, 0] and set(names(spark, folder)) == {"1", "2", "3"}
    _page(pages, "a.json", 0, ["1", "2", "4"])  # has changed
    assert [load(), load()] == [1, 0] and set(names(spark, folder)) == {"1", "2", "3", "4"}
    assert landing.new_files(spark, str(pages), f"{folder}/lake", "matches").count() == 2


def test_a_stop_before_the_note_loads_again(spark, folder, tmp_path, monkeypatch):
    pages = tmp_path / "pages"
    pages.mkdir()
    _page(pages, "a.json", 0, ["1", "2"])
    with monkeypatch.context() as patch:
        patch.setattr(landing, "_note_files", stop)
        with pytest.raises(Stopped):
            landing.load_new_pages(spark, str(pages), folder, "teams", f"{folder}/lake")
    assert landing.load_new_pages(spark, str(pages), folder, "teams", f"{folder}/lake") == 1
    assert set(names(spark, folder)) == {"1", "2"}


def test_pages_must_join(spark, tmp_path):
    def faults():
        rows = landing.page_faults(spark, str(tmp_path)).collect()
        return sorted(((r.expected, r.found, r.fault) for r in rows), key=str)

    _page(tmp_path, "a.json", 0, ["1", "2"])
    _page(tmp_path, "c.json", 3, ["4"])
    assert faults() == [(2, 3, "missing"), (4, None, "no end")]
    with pytest.raises(ValueError, match="do not join"):
        landing.read_pages(spark, str(tmp_path), complete=True)
    _page(tmp_path, "b.json", 2, ["3"])
    _page(tmp_path, "d.json", 4, [])
    assert faults() == []
    assert landing.read_pages(spark, str(tmp_path), complete=True).count() == 4
    _page(tmp_path, "e.json", 1, ["2"])
    assert faults() == [(2, 1, "repeated")]


def test_the_schema_of_many_pages_is_inferred_by_many_tasks(spark, tmp_path):
    for i in range(70):
        _page(tmp_path, f"{i}.json", i, [str(i)])
    (tmp_path / "lines.json").write_text('\n{"offset": 70,\n "data": [{"id": "x",\n "name": null, "rank": 1.5}]}\n')
    (tmp_path / "empty.json").write_text("")
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    for number, build in enumerate((landing.read_pages, landing.page_faults)):
        context.setJobGroup(f"pages-{number}", "")
        found = build(spark, str(tmp_path))
        jobs = tracker.getJobIdsForGroup(f"pages-{number}")
        stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert tracker.getStageInfo(max(stages)).numTasks > 1
        assert found.count() == (71, 1)[number]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert landing.read_pages(spark, str(tmp_path)).schema["rank"].dataType.typeName() == "double"
    (tmp_path / "broken.json").write_text('{"data": [')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        landing.read_pages(spark, str(tmp_path)).collect()


def test_a_load_reads_its_pages_once(spark, folder, tmp_path, monkeypatch):
    pages = tmp_path / "pages"
    pages.mkdir()
    _page(pages, "a.json", 0, ["1", "2"])
    read, upsert = [], landing.upsert_landed

    def noted(spark, folder, entity, new, *rest):
        read.extend(new.inputFiles())
        upsert(spark, folder, entity, new, *rest)

    monkeypatch.setattr(landing, "upsert_landed", noted)
    assert landing.load_new_pages(spark, str(pages), folder, "teams", f"{folder}/lake") == 1
    assert read and all(f.endswith(".parquet") for f in read)
    assert set(names(spark, folder)) == {"1", "2"}


def test_new_pages_of_whole_folders_are_read_as_folders(spark, folder, tmp_path, monkeypatch):
    pages, asked, read = tmp_path / "pages", [], landing.read_pages
    for number in range(3):
        (pages / str(number) / "more").mkdir(parents=True)
    monkeypatch.setattr(landing, "FEW_PATHS", 2)
    monkeypatch.setattr(landing, "read_pages", lambda s, paths, *a: asked.append(paths) or read(s, paths, *a))

    def load():
        return landing.load_new_pages(spark, str(pages), folder, "teams", f"{folder}/lake")

    _page(pages / "0", "old.json", 0, ["0"])
    assert load() == 1
    for name in ("a.json", "b.json"):
        _page(pages / "0", name, 0, [f"0{name}"])  # beside one that is not new
        _page(pages / "1", name, 0, [f"1{name}"])
        _page(pages / "2", name, 0, [f"2{name}"])
    _page(pages / "2" / "more", "c.json", 0, ["2c"])  # a folder within a folder
    assert [load(), load()] == [7, 0]
    made = sorted(p.split("/pages/")[1] for p in asked[1])
    assert made == ["0/a.json", "0/b.json", "1", "2/a.json", "2/b.json", "2/more"]
    assert set(names(spark, folder)) == {"0", "2c", *(f"{i}{n}.json" for i in range(3) for n in "ab")}


def test_versions_are_compressed(spark, folder, tmp_path):
    rows = spark.range(5000).selectExpr("CAST(id AS STRING) AS id", "'one and the same name' AS name")
    landing.write_landed(rows, folder, "teams")
    landing.upsert_landed(spark, folder, "teams", rows.where("id < 50").selectExpr("id", "'new' AS name"))
    files = [f for f in (tmp_path / ".teams.versions").rglob("part-*")]
    assert sum(f.stat().st_size for f in files) < 5000 * len('{"id":"1000","name":"one and the same name"}') / 2
    found = names(spark, folder)
    assert len(found) == 5000 and found["49"] == "new" and found["50"] == "one and the same name"


def test_offsets_of_pages(spark):
    ids = [i for i in range(0, 12_000, 7) if i // 400 % 6 != 2]
    found = checks._placed(spark.createDataFrame([(str(i),) for i in ids], "id string"), 4).collect()
    assert {r.page: r.offset for r in found} == {i // 400: sum(j // 400 < i // 400 for j in ids) for i in ids}
    assert all(len(r.data) == sum(i // 400 == r.page for i in ids) for r in found)


def test_pages_of_little_data_are_written_by_many_tasks(spark, monkeypatch):
    written = []
    monkeypatch.setattr(checks, "_write_pages", lambda pages, folder: written.append(pages) or stop())
    matches = derived.stored_views(spark, "/root/testdata/sf0.001")
    with pytest.raises(Stopped):
        checks.page_faults(matches)
    assert "REPARTITION_BY_NUM" in written[0]._jdf.queryExecution().executedPlan().toString()


def test_export_in_display_order(spark, tmp_path):
    gold = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "Match_id string, n int")
    tables.write_table(gold, f"{tmp_path}/gold", "fct_national_matches")
    rows = registry.export_in_display_order(spark, f"{tmp_path}/gold", f"{tmp_path}/out", ["fct_national_matches"])
    assert rows == {"fct_national_matches": 3}
    found = tables.read_table(spark, f"{tmp_path}/out", "fct_national_matches").collect()
    assert {r.n: r.display_place for r in found} == {3: 1, 2: 2, 1: 3}
