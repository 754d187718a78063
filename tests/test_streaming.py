"""The log ETL as a file stream (availableNow)."""

from tests.test_weblog import LINES


def test_extract_stream(spark, tmp_path):
    from logloom.streaming.log_stream import start_extract_stream
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "part1.log").write_text("\n".join(LINES) + "\n")
    q = start_extract_stream(spark, str(logs), str(tmp_path / "known"), str(tmp_path / "unknown"),
                             str(tmp_path / "ckpt"), domains=["ref.example.com"], available_now=True)
    q.awaitTermination(120)
    known = spark.read.parquet(str(tmp_path / "known"))
    unknown = spark.read.parquet(str(tmp_path / "unknown"))
    assert known.count() == 2 and unknown.count() == 2
    assert set(known.columns) >= {"domain", "batch_id", "clean_path"}
