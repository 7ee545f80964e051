"""The incremental landing ingest equals the batch reader and is idempotent."""

import json

from paddock.plans.bindings import entries
from paddock.session import scratch_dir
from paddock.sources import landing as L
from paddock.streaming.landing import ingest_landed_races, landed_races


def test_stream_matches_batch_and_runs_once(spark, sf_small):
    land, table, ckpt = scratch_dir(spark, "land"), scratch_dir(spark, "tbl"), scratch_dir(spark, "ck")
    L.land_races(entries(spark, sf_small), land)
    ingest_landed_races(spark, land, table, ckpt).awaitTermination()
    ingest_landed_races(spark, land, table, ckpt).awaitTermination()
    got, ref = landed_races(spark, table), L.read_races(spark, land)
    assert got.count() == ref.count()
    assert got.select(*ref.columns).exceptAll(ref).count() == 0


def test_chunks_of_a_race_in_two_batches(spark, tmp_path):
    land = tmp_path / "land" / "race_date=2024-01-01"
    land.mkdir(parents=True)
    for i in range(2):
        row = {"race_id": "r1", "race_name": "R", "race_number": 1, "course": "c", "distance": 1000, "chunk": i,
               "entries": [{"horse_id": f"h{3 * i + k}"} for k in range(3)]}
        (land / f"part-{i}.json").write_text(json.dumps(row))
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    ingest_landed_races(spark, str(tmp_path / "land"), table, ckpt, max_files_per_trigger=1).awaitTermination()
    got = landed_races(spark, table).collect()
    assert len(got) == 1 and got[0]["num_entries"] == 6
