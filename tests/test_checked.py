import gzip

import pytest

from tidewatch.sources.checked import read_checked


def test_broken_files_are_skipped_and_listed(spark, tmp_path):
    text = "a,b\n" + "".join(f"{i},x{i}\n" for i in range(2000))
    (tmp_path / "one + 1%.csv").write_text(text)
    (tmp_path / "bad rows.csv").write_text("a,b\n1,2,3\n4\n5,é\n")
    (tmp_path / "binary.csv").write_bytes(bytes(range(256)) * 20)
    (tmp_path / "nul.csv").write_bytes(b"a,b\n1,\0\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(text.encode())[:-500])
    (tmp_path / "false.csv.gz").write_text(text)
    rows, outcome = read_checked(spark, str(tmp_path), ["a", "b"])
    found = {r["path"].rsplit("/", 1)[1]: (r["rows"], r["bad_records"], r["why"]) for r in outcome.collect()}
    assert found == {
        "one + 1%.csv": (2000, 0, None), "bad rows.csv": (3, 2, None), "binary.csv": (0, 0, "not UTF-8 text"), "nul.csv": (0, 0, "not UTF-8 text"),
        "empty.csv": (0, 0, "no rows"), "blank.csv": (0, 0, "no rows"), "packed.csv.gz": (2000, 0, None),
        "cut.csv.gz": (0, 0, "cannot be unpacked: EOFError"), "false.csv.gz": (0, 0, "cannot be unpacked: BadGzipFile"),
    }
    assert rows.count() == 4003 and rows.columns == ["a", "b"]


def test_a_folder_of_broken_files_has_no_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    rows, outcome = read_checked(spark, str(tmp_path), ["a"])
    assert rows.count() == 0 and rows.columns == ["a"] and [r["skipped"] for r in outcome.collect()] == [True]
    with pytest.raises(FileNotFoundError):
        read_checked(spark, str(tmp_path / "absent"), ["a"])
