"""The ``spark-submit`` entries from a written dump to plays per album."""

from __future__ import annotations

import json

from cratewise import jobs
from cratewise.sources.manifest import catalogue_manifest
from cratewise.sources.sinks import read_target
from verification.registry import write_dump

SF = "/root/testdata/sf0.001"


def test_build_sample_and_history(spark, tmp_path):
    dump, out, sample = f"{tmp_path}/dump", f"{tmp_path}/out", f"{tmp_path}/sample"
    write_dump(spark, SF, dump)
    jobs.main(["build", dump, out, "--dump-version", "v1"])
    jobs.main(["tidy", out])
    jobs.main(["sample", dump, sample, "--releases", "3"])
    assert all(spark.read.text(f"{sample}/{spec.file_name}") for spec in catalogue_manifest().values())

    link = read_target(spark, out, "link_lookup", "v1").filter("provider = 'spotify'").first()
    plays = [{"ms_played": 7, "spotify_track_uri": f"spotify:track:{link.url_identifier}"}, {"ms_played": 5}]
    for lines, text in ((False, json.dumps(plays)), (True, "\n".join(map(json.dumps, plays)))):
        history, found = tmp_path / f"history-{lines}", f"{tmp_path}/found-{lines}"
        history.mkdir()
        (history / "plays.json").write_text(text)
        flags = ["--lines"] if lines else []
        jobs.main(["history", str(history), out, found, "--dump-version", "v1", *flags])
        rows = {r.ms_played: r.matched_by for r in spark.read.parquet(f"{found}/plays").collect()}
        assert rows == {7: "link", 5: None}
        albums = spark.read.parquet(f"{found}/albums").agg({"plays": "sum"}).first()
        assert albums[0] == 2
