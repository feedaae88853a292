"""Blocks of sets reach Python a few pairs at a time (operators 2 and 5)."""

from pyspark.sql import functions as F

from seriesforge.llm import near_dup as ND

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_pairs_of_blocks_come_in_small_batches(spark, monkeypatch):
    """One bucket of 700 unlike sets has 11 x 11 pairs of blocks; two of them are alike."""
    most = ND.PAIRS
    plain = ND._block_links

    def watched(percent):
        links = plain(percent)

        def run(batches):
            def seen():
                for batch in batches:
                    assert batch.num_rows <= most, batch.num_rows
                    yield batch
            yield from links(seen())
        return run

    monkeypatch.setattr(ND, "_block_links", watched)
    word = F.expr("array_join(transform(sequence(0, 13), i -> concat('w', if(id = 8, 7, id), '_', i)), ' ')")
    base = spark.range(700).select("id", F.unhex(F.md5(F.col("id").cast("string"))).alias("set_id"), F.concat(word, F.when(F.col("id") == 8, " more").otherwise("")).cast("binary").alias("text"))
    rows = base.select("set_id", F.array(F.lit(7).cast("long")).alias("bands"))
    sets = base.select("set_id", F.lit(10).cast("long").alias("n_shingles"))
    before = spark.conf.get(ROWS)
    roots = ND.linked_sets(rows, sets, lambda wanted: base.join(wanted, "set_id", "left_semi").select("set_id", "text"))
    found = roots.join(base, roots["node"] == base["set_id"]).select("id", "root").collect()
    assert sorted(r["id"] for r in found) == [7, 8] and len({bytes(r["root"]) for r in found}) == 1
    assert spark.conf.get(ROWS) == before
