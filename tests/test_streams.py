"""The streaming queries over tables in one file and in a folder of part files."""

from pairmill.catalog import registry, streams


def test_stream_reads_files_and_folders(spark, tmp_path):
    turns = spark.createDataFrame(
        [(c, t, "user" if t % 2 else "assistant", f"where is order {c} {t}") for c in range(20) for t in range(1, 5)],
        "conv_id bigint, turn bigint, role string, text string")
    docs = spark.createDataFrame([(i, "where is my order\nthe order is here now\nthanks a lot then", "en", "web")
                                  for i in range(5)], "doc_id bigint, text string, lang string, source string")
    folder, single = tmp_path / "folder", tmp_path / "single"
    for sf, parts in ((folder, 3), (single, 1)):
        sf.mkdir()
        for name, df in (("conversations", turns), ("documents", docs)):
            path = sf / f"{name}.parquet"
            if parts > 1:
                df.repartition(parts).write.parquet(str(path))
            else:
                df.toPandas().to_parquet(path)
    out = [registry.ENTRIES["live_gate"].run(spark, str(sf)) for sf in (folder, single)]
    assert [df.count() for df in out] == [40, 40]
    assert out[0].exceptAll(out[1]).count() == 0
    assert streams.stream_of(spark, str(folder), "documents").isStreaming
