from clinicgen.llm import files


def test_hadoop_paths_as_pyarrow_spells_them(tmp_path):
    assert files.uri("s3a://bucket/a/b") == "s3://bucket/a/b" == files.uri("s3n://bucket/a/b")
    assert files.uri("hdfs://nn:8020/x") == "hdfs://nn:8020/x" and files.uri("gs://b/x") == "gs://b/x" == files.uri("gcs://b/x")
    assert files.uri("abfss://c@a.dfs.core.windows.net/x") == "abfss://c@a.dfs.core.windows.net/x"
    assert files.uri("file:/tmp/x") == "file:///tmp/x" == files.uri("file:///tmp/x")
    for path in (f"{tmp_path}/a/x.bin", f"file:{tmp_path}/b/x.bin", f"file://{tmp_path}/c/x.bin"):
        with files.create(path) as out:
            out.write(b"abc")
        assert files.open_random(path).read() == b"abc" == files.open_stream(path).read()
