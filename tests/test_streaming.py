from larkspur.streaming import votes


def test_windows_of_a_stream_match_a_batch(spark, sf_dir, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(str(src))
    out = votes.windowed(votes.read_votes(spark, str(src)), "1 hour", "3650 days")
    q = out.writeStream.outputMode("complete").format("memory").queryName("votes").start()
    q.processAllAvailable()
    q.stop()
    batch = votes.windowed(spark.read.parquet(f"{sf_dir}/events.parquet"))
    pick = lambda df: sorted((r["start"], r["event_type"], r["n"]) for r in df.collect())
    assert pick(spark.table("votes")) == pick(batch)


def test_finished_windows_are_appended(spark, sf_dir, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{sf_dir}/events.parquet").write.parquet(str(src))
    q = votes.write_windows(votes.windowed(votes.read_votes(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
