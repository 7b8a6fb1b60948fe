import csv

import pytest

from checks import inputs
from grantlens.plans import scoring
from grantlens.sources.tables import read_text_files
from grantlens.streaming import reports

NAMES = list(scoring.FILE_REPORT)


@pytest.fixture
def places(tmp_path):
    (tmp_path / "in").mkdir()
    return [str(tmp_path / name) for name in ("in", "out", "state")]


def land(folder, files):
    for name, text in files.items():
        with open(f"{folder}/{name}", "wb") as file:
            file.write(text)


def printed(tmp_path):
    """Cells of every CSV part by file, and the headings met."""
    rows, headings = {}, set()
    for part in (tmp_path / "out").glob("batch=*/part-*.csv"):
        lines = list(csv.reader(part.open()))
        headings.add(tuple(lines[0]))
        for line in lines[1:]:
            name = line[0].rpartition("/")[2]
            assert name not in rows
            rows[name] = line
    return rows, headings


def test_every_file_is_reported_once(spark, places, tmp_path):
    lexicon = inputs.finance(spark)
    folder, out, state = places
    assert reports.report_new_files(spark, folder, lexicon, out, state) == 0
    land(folder, {"a.txt": b"The cost, loss and gain of 2009.", "b.txt": b"caf\xe9 12", "skip.md": b"no", "none.txt": b""})
    assert reports.report_new_files(spark, folder, lexicon, out, state) == 1
    assert reports.report_new_files(spark, folder, lexicon, out, state) == 0
    land(folder, {"c.txt": b"words\nof a May day", "d.txt": b"\n", "e.txt": b"more"})
    assert reports.report_new_files(spark, folder, lexicon, out, state, files_per_batch=2) == 2
    rows, headings = printed(tmp_path)
    assert set(rows) == {"a.txt", "b.txt", "c.txt", "d.txt", "e.txt"}
    assert headings == {tuple(scoring.FILE_REPORT.values())}
    whole = scoring.file_report(read_text_files(spark, f"{folder}/*.txt"), lexicon)
    read = reports.read_reports(spark, out, whole)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, whole.collect()))


def test_a_batch_run_again_replaces_itself(spark, places):
    lexicon = inputs.finance(spark)
    folder, out, _ = places
    land(folder, {"a.txt": b"The loss", "b.txt": b"gain"})
    files = read_text_files(spark, f"{folder}/*.txt")
    write = reports.report_batches(lexicon, out)
    for _ in range(2):
        write(files, 0)
    write(files.where("path like '%a.txt'"), 1)
    sample = scoring.file_report(files, lexicon)
    assert sample.columns == NAMES and reports.read_reports(spark, out, sample).count() == 3


def test_files_named_by_a_batch_are_listed_together(spark, tmp_path):
    """A batch names its files; listing them is no task for each of them."""
    paths = []
    for i in range(150):
        (tmp_path / f"{i}.txt").write_text("word")
        paths.append(str(tmp_path / f"{i}.txt"))
    context = spark.sparkContext
    context.setJobGroup("listing of names", "")
    try:
        assert spark.read.text(paths, wholetext=True).count() == 150
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing of names") for s in tracker.getJobInfo(job).stageIds]
    assert max(tracker.getStageInfo(stage).numTasks for stage in stages if tracker.getStageInfo(stage)) <= 64
