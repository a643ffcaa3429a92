"""Golden table cases: a folder each, with the table in delta/ and what it must hold in expected/.

TARN_GOLDEN_DIR names a folder of such cases; without it, one made from a fixture is run.
"""

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import types as T

from tarn import fixtures
from tarn.plans.scan import scan
from tarn.sources import snapshot

#: Cases that ask for what readers need not know.
SKIP = {"iceberg_compat_v1"}
CORPUS = os.environ.get("TARN_GOLDEN_DIR")
CASES = sorted(p.parent for p in Path(CORPUS).glob("**/test_case_info.json")) if CORPUS else []


def rows_of(df):
    """Rows sorted by all columns that are not nested; field names and types count, nullability and metadata do not."""
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return kinds, sorted((r.asDict(True) for r in df.collect()), key=lambda r: [(r[c] is not None, str(r[c])) for c in flat])


def check_case(spark, case: Path) -> None:
    table = str(case / "delta")
    for path in sorted(case.glob("expected/**/table_version_metadata.json")):
        want = json.loads(path.read_text())
        latest = path.parent.name == "latest"
        s = snapshot.load(spark, table, None if latest else want["version"])
        assert s.version == want["version"]
        assert s.metadata.configuration == want["properties"]
        assert (s.protocol.min_reader_version, s.protocol.min_writer_version) == (want["min_reader_version"], want["min_writer_version"])
        content = path.parent / "table_content"
        if content.is_dir():
            assert rows_of(scan(s)) == rows_of(spark.read.parquet(*map(str, content.glob("**/*.parquet"))))


@pytest.mark.parametrize("case", CASES, ids=lambda p: p.name)
def test_corpus(spark, case):
    if case.name in SKIP:
        pytest.skip("not a reader's case")
    check_case(spark, case)


@pytest.mark.parametrize("name", ["multi_commit", "partitioned", "evolved"])
def test_a_made_case(spark, sf_dir, tmp_path, name):
    root = fixtures.path_of(spark, sf_dir, name)
    shutil.copytree(root, tmp_path / "delta")
    s = snapshot.load(spark, root)
    for folder, version in (("latest", None), ("v0", 0)):
        v = snapshot.load(spark, root, version)
        out = tmp_path / "expected" / folder
        scan(v).write.parquet(str(out / "table_content"))
        meta = {"version": v.version, "properties": {}, "min_reader_version": s.protocol.min_reader_version, "min_writer_version": s.protocol.min_writer_version}
        (out / "table_version_metadata.json").write_text(json.dumps(meta))
    (tmp_path / "test_case_info.json").write_text(json.dumps({"name": name, "description": ""}))
    check_case(spark, tmp_path)
    (tmp_path / "expected" / "latest" / "table_version_metadata.json").write_text(json.dumps(meta | {"version": 77}))
    with pytest.raises(AssertionError):
        check_case(spark, tmp_path)
