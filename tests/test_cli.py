"""The command line: names, defaults, whole configurations, and a run from files to files."""

from __future__ import annotations

import json

import pytest

from voxelith import __main__ as cli


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(0, 0, x, 1 + x // 3) for x in range(9)], "z long, y long, x long, label long").write.parquet(f"{tmp_path}/volume")
    spark.createDataFrame([(3, 1)], "label long, body long").write.parquet(f"{tmp_path}/merges")
    config = {"input": {"table": {"path": "volume"}}, "options": {"block": 4, "offset": [0, 0, 2]}, "tables": {"mapping": "merges"}, "output": "out"}
    (tmp_path / "run.json").write_text(json.dumps(config))
    return tmp_path


def test_names_and_defaults(capsys):
    assert cli.main(["-l"]) == 0 and "copy_segmentation" in capsys.readouterr().out.split()
    assert cli.main(["-d", "copy_segmentation"]) == 0
    assert json.loads(capsys.readouterr().out) == {"block": 64, "depth": 0, "mapping": None, "offset": [0, 0, 0], "store": None}
    for wrong in ([], ["copy_segmentation"], ["no_such_workflow"]):
        with pytest.raises(SystemExit):
            cli.main(wrong)


def test_whole_configuration(folder, capsys):
    assert cli.main(["-c", f"{folder}/run.json", "-v", "copy_segmentation"]) == 0
    shown = json.loads(capsys.readouterr().out)
    assert shown["options"] == {"block": 4, "depth": 0, "mapping": None, "offset": [0, 0, 2], "store": None}
    assert shown["input"]["table"]["path"] == f"{folder}/volume" and shown["input"]["scale"] == 0 and shown["output"] == f"{folder}/out"


def test_run(spark, folder, capsys):
    assert cli.main(["-c", f"{folder}/run.json", "copy_segmentation"], spark) == 0
    assert "voxels" in capsys.readouterr().out.split()
    got = spark.read.parquet(f"{folder}/out/voxels").where("scale = 0")
    assert sorted((r.x, r.label) for r in got.collect()) == [(x + 2, 1 if x // 3 == 2 else 1 + x // 3) for x in range(9)]


def test_yaml(spark, folder, capsys):
    yaml = pytest.importorskip("yaml")
    (folder / "run.yaml").write_text(yaml.safe_dump(json.loads((folder / "run.json").read_text())))
    assert cli.main(["-c", f"{folder}/run.yaml", "-v", "-y", "copy_segmentation"]) == 0
    assert yaml.safe_load(capsys.readouterr().out)["options"]["block"] == 4


def test_unknown_options(spark, folder):
    config = json.loads((folder / "run.json").read_text())
    (folder / "wrong.json").write_text(json.dumps(config | {"options": {"blocks": 4}}))
    with pytest.raises(SystemExit, match="blocks"):
        cli.main(["-c", f"{folder}/wrong.json", "copy_segmentation"], spark)
    (folder / "empty.json").write_text("{}")
    with pytest.raises(SystemExit, match="input"):
        cli.main(["-c", f"{folder}/empty.json", "copy_segmentation"], spark)
