"""The command line from files to exported conversations."""

import json

import pytest

from lumenweave.__main__ import main


def test_commands(spark, tmp_path, capsys):
    root, folder = tmp_path / "root", str(tmp_path / "catalogue")
    (root / "vsr").mkdir(parents=True)
    (root / "vsr/all_vsr_validated_data.jsonl").write_text("\n".join(json.dumps({"image": f"{i}.jpg", "caption": f"Thing {i} stands on the table. It is old."}) for i in range(5)))
    main([folder, "load", str(root), "vsr"])
    main([folder, "generate", "--images", "3"])
    main([folder, "generate", "--images", "3"])
    main([folder, "count"])
    assert "|0     |5       |0      |" in capsys.readouterr().out
    main([folder, "stats", "--run", "0"])
    assert "5|" in capsys.readouterr().out
    main([folder, "export", str(tmp_path / "out"), "--run", "0"])
    assert spark.read.json(str(tmp_path / "out")).count() >= 5
    main([folder, "clean", "--all", "--run", "0"])
    main([folder, "stats"])
    assert "0|" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main([folder, "clean"])
