"""Zips read at their paths, member by member."""

import zipfile

import pytest

from reportloom.sources import archives


def make_zip(path, members, method=zipfile.ZIP_DEFLATED):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", method) as held:
        for name, content in members:
            held.writestr(name, content)


def records(df):
    return sorted(tuple(r) for r in df.select("path", "member", "row_no", "fields", "numbered_member").collect())


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_members_at_their_places_equal_whole_zips(spark, tmp_path, method):
    many = "\n".join(f'{i},"a ""q""\nb",é' for i in range(9_000))
    members = [("folder/", ""), ("folder/one.csv", "h1,h2\n1,2\n"), ("empty.csv", ""), ("many.csv", many), ("blank.csv", "\n\n")]
    make_zip(tmp_path / "z" / "earnings_202101_1-2 x.zip", members, method)
    make_zip(tmp_path / "z" / "none.zip", [])
    whole = archives.scan_objects(spark, str(tmp_path / "z"))
    got = records(archives.expand_archives(whole.select("path")))
    assert got == records(archives.expand_archives(whole))
    assert len(got) == 2 + 9_000 + 2
    assert archives.expand_archives(whole.select("path").limit(0)).count() == 0


def test_every_member_is_a_task(spark, tmp_path):
    make_zip(tmp_path / "z" / "a.zip", [(f"{i}.csv", f"h\n{i}\n") for i in range(40)])
    paths = archives.scan_objects(spark, str(tmp_path / "z")).select("path")
    rows = archives.expand_archives(paths)
    assert rows.rdd.getNumPartitions() == 40
    assert {(r.member, r.fields[0]) for r in rows.where("row_no = 1").collect()} == {(f"{i}.csv", str(i)) for i in range(40)}


def test_damaged_and_unnamed_members_fail(spark, tmp_path):
    make_zip(tmp_path / "z" / "a.zip", [("a.csv", "h,app\n1,x\n")], zipfile.ZIP_STORED)
    paths = archives.scan_objects(spark, str(tmp_path / "z")).select("path")
    named = archives.expand_archives(paths, named="app").where("row_no = 1").first()
    assert named.named == "x"
    with pytest.raises(Exception, match="no column 'other'"):
        archives.expand_archives(paths, named="other").collect()
    file = tmp_path / "z" / "a.zip"
    file.write_bytes(file.read_bytes().replace(b"1,x", b"2,x"))
    with pytest.raises(Exception, match="CRC"):
        archives.expand_archives(paths).collect()
