"""Commands over landed pages as they come: tail under controls, and presets over the stored tables."""

import json

from evigrid.__main__ import main
from evigrid.plans import query

from test_surface import PAGE, RULES


def test_tail_and_presets(spark, tmp_path, capsys):
    store = f"file://{tmp_path}/store"

    def call(*argv):
        code = main(["--store", store, *argv], spark)
        out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        assert code == 0, out
        return out["data"]

    def land(*hosts):
        rows = [(f"https://{h}/team", PAGE.replace("Ann", h.split(".")[0].title()), 200, f"https://{h}") for h in hosts]
        spark.createDataFrame(rows, "url string, html string, status_code int, seed_website string").coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))

    hosts = ("hill.org", "lake.org", "wood.org")
    (tmp_path / "seeds.json").write_text(json.dumps({"sources": [{"name": h.split(".")[0], "website": f"https://{h}", "state": "NJ", "tier": "A", "source_type": "practice_site"} for h in hosts]}))
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    argv = ("tail", "--pages", str(tmp_path / "pages"), "--seeds", str(tmp_path / "seeds.json"), "--rules", str(tmp_path / "rules.json"), "--run-id", "t", "--iterations", "1")
    land("hill.org")
    assert [r["run_id"] for r in call(*argv)["runs"]] == ["t-000000"]
    call("control", "stop-domain", "wood.org", "--reason", "enough")
    land("lake.org", "wood.org")
    assert [r["run_id"] for r in call(*argv)["runs"]] == ["t-000001"]
    assert call(*argv)["runs"] == []
    assert {r["provider_name"] for r in call("sql", "SELECT provider_name_snapshot AS provider_name FROM decided")} == {"Hill Lee", "Lake Lee"}
    for name in query.PRESETS:
        assert isinstance(call("preset", name), list)
