import os

import data
from tidemark.sources import files


def write(path, size, stamp):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"x" * size)
    os.utime(path, (stamp, stamp))


def test_inventory(spark, tmp_path):
    for i in range(7):
        write(tmp_path / "orders" / f"day={i}" / f"f{i}.parquet", 10 + i, 1_700_000_000 + i)
    write(tmp_path / "customers" / "a.parquet", 5, 1_700_000_000)
    write(tmp_path / "notes.txt", 3, 1_700_000_000)
    found = files.with_folder(files.list_files(spark, str(tmp_path)), str(tmp_path))
    assert tuple(files.total_size(found).first()) == (9, 99)
    assert data.values(files.folder_sizes(found), "folder", "files", "bytes") == [
        ("customers", 1, 5),
        ("orders", 7, 91),
        ("root", 1, 3),
    ]
    newest = files.newest_files(found).where("folder = 'orders'")
    assert sorted(r.path[-10:] for r in newest.collect()) == [f"f{i}.parquet" for i in range(2, 7)]


def test_listing_opens_no_file(spark, tmp_path):
    write(tmp_path / "a.bin", 5, 1_700_000_000)
    plan = files.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
