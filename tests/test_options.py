import pytest

from tablelift.options import DEFAULT_FILE_BYTES, MB, ExportOptions


def settled(**given):
    return ExportOptions(target="/out", **given).checked()


def test_default_size_applies_when_nothing_is_given():
    assert settled().target_file_bytes == DEFAULT_FILE_BYTES
    assert settled().max_rows_per_file is None


def test_size_wins_over_rows(caplog):
    options = settled(target_file_bytes=10 * MB, max_rows_per_file=5)
    assert (options.target_file_bytes, options.max_rows_per_file) == (10 * MB, None)
    assert "row limit is ignored" in caplog.text


def test_rows_alone_keep_the_default_size():
    options = settled(max_rows_per_file=5)
    assert (options.target_file_bytes, options.max_rows_per_file) == (DEFAULT_FILE_BYTES, 5)


def test_sizes_above_the_maximum_fall_back(caplog):
    assert settled(target_file_bytes=1025 * MB).target_file_bytes == DEFAULT_FILE_BYTES
    assert settled(target_file_bytes=1024 * MB).target_file_bytes == 1024 * MB
    assert settled(target_file_bytes=600 * MB).target_file_bytes == 600 * MB
    assert "slow down readers" in caplog.text


@pytest.mark.parametrize(
    "fmt, asked, used",
    [
        ("parquet", "gzip", "snappy"),
        ("parquet", "zstd", "zstd"),
        ("parquet", "none", "none"),
        ("csv", "snappy", "gzip"),
        ("tsv", "snappy", "gzip"),
        ("json", "snappy", "gzip"),
        ("json", "zstd", "zstd"),
        ("csv", "none", "none"),
    ],
)
def test_codec_fallback(fmt, asked, used):
    assert settled(format=fmt, compression=asked).compression == used


@pytest.mark.parametrize(
    "fmt, codec, name",
    [
        ("parquet", "zstd", "part-00007.parquet"),
        ("csv", "gzip", "part-00007.csv.gz"),
        ("tsv", "zstd", "part-00007.tsv.zst"),
        ("json", "none", "part-00007.jsonl"),
    ],
)
def test_file_names(fmt, codec, name):
    assert settled(format=fmt, compression=codec).file_name(7) == name


@pytest.mark.parametrize(
    "wrong",
    [
        {"format": "orc"},
        {"compression": "lz4"},
        {"mode": "merge"},
        {"consistency": "serializable"},
        {"table_concurrency": 0},
        {"slice_concurrency": 0},
        {"io_concurrency": 0},
        {"memory_limit_mb": 63},
        {"resume": True},
        {"max_rows_per_file": 0},
        {"target_file_bytes": 0},
    ],
)
def test_wrong_options_are_refused(wrong):
    with pytest.raises(ValueError):
        settled(**wrong)


def test_empty_target_is_refused():
    with pytest.raises(ValueError, match="target"):
        ExportOptions(target="  ").checked()
