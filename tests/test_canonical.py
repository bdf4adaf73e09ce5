"""Canonical JSON against Python's json and unicodedata."""

import hashlib
import json
import unicodedata

import pyarrow as pa
import pytest

from cogwright.functions import canonical
from cogwright.functions.canonical import with_canonical_json, with_record_sha256


def plain(x):
    if isinstance(x, str):
        return unicodedata.normalize("NFC", x)
    if isinstance(x, dict):
        return {plain(k): plain(v) for k, v in x.items()}
    return [plain(v) for v in x] if isinstance(x, list) else x


def text(row):
    return json.dumps(plain(row), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_plain_and_other_rows(spark):
    rows = [
        ("a", 1, 2.0, True), ("é", -5, 0.1, None), ("é", 2**60, 1e300, False), ('q"\\/\n\t\x01\x1f\x7f', 0, -0.0, True), (" ﬁ", None, 1e-7, None), (None, 7, 123456789.0, None), ("{}", 8, None, True), ("퟿\U0001f600", 9, 2.0**-1074, True), ("\\u00e9", 1, 5.0, None),
    ]
    df = spark.createDataFrame(rows, "s string, n long, `a.b` double, z boolean")
    want = [text(dict(zip(("s", "n", "a.b", "z"), r, strict=True))) for r in rows]
    got = with_canonical_json(df, df.columns).collect()
    assert [r.canonical for r in got] == want
    assert [r.record_sha256 for r in with_record_sha256(df, df.columns).collect()] == [hashlib.sha256(w.encode()).hexdigest() for w in want]


def test_nested(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2}, [("z", 0.5), ("é", None)])], "m map<string,int>, l array<struct<y:string,x:double>>")
    assert with_canonical_json(df, ["m", "l"]).first().canonical == '{"l":[{"x":0.5,"y":"z"},{"x":null,"y":"é"}],"m":{"a":2,"b":1}}'


def test_no_number(spark):
    for bad in ("NaN", "Infinity"):
        with pytest.raises(Exception, match="no finite number"):
            with_canonical_json(spark.sql(f"select double('{bad}') x"), ["x"]).collect()


def test_batches_in_slices(monkeypatch):
    texts = [None, '{"b":"e\u0301","a":1}', None, '["x"]', "0.10"]
    for chars in (1, 25, 1 << 20):
        monkeypatch.setattr(canonical, "SLICE_CHARS", chars)
        for n in range(len(texts) + 1):
            assert canonical._rewrite(pa.array(texts[:n], pa.string())).to_pylist() == [None, '{"a":1,"b":"\u00e9"}', None, '["x"]', "0.1"][:n]
