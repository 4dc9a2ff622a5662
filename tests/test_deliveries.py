import datetime
import hashlib
import os

import pytest

from claimloom.schemas import FILE_HEADERS
from claimloom.sources import deliveries
from claimloom.sources.deliveries import DeliveredFile

DAY = datetime.date(2024, 2, 1)
HEADER = FILE_HEADERS["payments.csv"]


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(text if isinstance(text, bytes) else text.encode())
    return path


def report(spark, path, name="payments.csv"):
    headers = deliveries.file_headers(spark, [DeliveredFile(name, path)])
    return deliveries.contract_report(headers)


def test_missing_column_is_an_error_naming_it(spark, tmp_path):
    path = put(str(tmp_path), "payments.csv", HEADER.replace("payment_date,", "") + "\n")
    with pytest.raises(deliveries.ContractError, match="payments.csv.*payment_date"):
        deliveries.check_contract(report(spark, path))


def test_extra_column_is_a_warning(spark, tmp_path, caplog):
    path = put(str(tmp_path), "payments.csv", HEADER + ",channel\n")
    assert list(deliveries.check_contract(report(spark, path)).values()) == [[(HEADER + ",channel").split(",")]]
    assert "channel" in caplog.text


def test_order_blanks_and_line_ends_do_not_matter(spark, tmp_path):
    shuffled = " , ".join(reversed(HEADER.split(",")))
    path = put(str(tmp_path), "payments.csv", f" {shuffled} \r\n")
    row = report(spark, path).first()
    assert (row.missing, row.extra) == ([], [])


def test_byte_order_mark_hides_the_first_column(spark, tmp_path):
    path = put(str(tmp_path), "payments.csv", b"\xef\xbb\xbf" + HEADER.encode() + b"\n")
    assert report(spark, path).first().missing == ["payment_id"]


def test_file_without_contract_passes(spark, tmp_path):
    path = put(str(tmp_path), "other.csv", "a,b\n")
    row = report(spark, path, "other.csv").first()
    assert (row.missing, row.extra) == ([], [])


def test_header_longer_than_a_block(spark, tmp_path):
    wide = HEADER + "," + ",".join(f"c{i}" for i in range(20000))
    path = put(str(tmp_path), "payments.csv", wide + "\n1,2\n")
    assert len(report(spark, path).first().extra) == 20000


def test_absent_files_are_reported_and_skipped(spark, tmp_path):
    put(str(tmp_path), "payments.csv", HEADER + "\n")
    put(str(tmp_path), "unexpected.csv", "x\n")
    found, absent = deliveries.find_files(spark, str(tmp_path))
    assert [f.name for f in found] == ["payments.csv"]
    assert absent == ["claimants.csv", "claims_v1.csv", "claims_v2.csv", "employers.csv", "policies.csv"]


def test_copy_is_exact_and_listed(spark, tmp_path):
    inbox, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    whole = (HEADER + "\n" + "1,2,2024-01-01,3.5,x,2024-01-01 00:00:00\n").encode() * 3
    put(inbox, "payments.csv", whole)
    put(inbox, "claims_v1.csv/part-0.csv", FILE_HEADERS["claims_v1.csv"] + "\n")
    put(inbox, "claims_v1.csv/part-1.csv", FILE_HEADERS["claims_v1.csv"] + "\n")
    put(inbox, "claims_v1.csv/_SUCCESS", "")
    put(raw, f"claims/{DAY}/claims_v1.csv/part-9.csv", "left over")
    files, _ = deliveries.find_files(spark, inbox)
    manifest = deliveries.copy_to_raw(spark, files, raw, DAY, "test").collect()
    rows = {os.path.relpath(r.path, raw): r for r in manifest}
    assert set(rows) == {
        f"payments/{DAY}/payments.csv", f"claims/{DAY}/claims_v1.csv/part-0.csv", f"claims/{DAY}/claims_v1.csv/part-1.csv"
    }
    row = rows[f"payments/{DAY}/payments.csv"]
    assert (row.md5, row.length) == (hashlib.md5(whole).hexdigest(), len(whole))
    assert (row.entity, row.ingestion_date, row.source) == ("payments", DAY, "test")
    assert open(row.path, "rb").read() == whole
    assert sorted(os.listdir(f"{raw}/claims/{DAY}/claims_v1.csv")) == ["part-0.csv", "part-1.csv"]


def test_files_with_different_headers_are_read_by_name(spark, tmp_path):
    put(str(tmp_path), f"payments/{DAY}/payments.csv/a.csv", "payment_id, claim_id\n1,10\n")
    put(str(tmp_path), f"payments/{DAY}/payments.csv/b.csv", "claim_id,payment_id,note\n20,2,\"x, y\"\n")
    raw = deliveries.read_raw(spark, str(tmp_path), DAY, ["payments.csv"])
    rows = raw["payments.csv"].orderBy("payment_id").collect()
    assert [(r.payment_id, r.claim_id, r.note) for r in rows] == [("1", "10", None), ("2", "20", "x, y")]


def test_undelivered_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="payments.csv"):
        deliveries.read_raw(spark, str(tmp_path), DAY, ["payments.csv"])


def test_many_parts_are_listed_and_copied_a_partition_at_a_time(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in" / "payments.csv"
    os.makedirs(folder)
    for i in range(600):
        (folder / f"part {i}+%20.csv").write_text(f"{HEADER}\n{i},1,2024-01-01,1,x,\n")
    put(str(tmp_path / "in"), "policies.csv", FILE_HEADERS["policies.csv"] + "\n")
    files, absent = deliveries.list_files(spark, str(tmp_path / "in"))
    assert absent == ["claimants.csv", "claims_v1.csv", "claims_v2.csv", "employers.csv"]
    assert files.count() == 601 and files.rdd.getNumPartitions() < 60
    headers = deliveries.file_headers(spark, files)
    assert [len(h) for h in deliveries.check_contract(deliveries.contract_report(headers)).values()] == [1, 1]
    deliveries.copy_to_raw(spark, files, str(tmp_path / "raw"), DAY).write.parquet(str(tmp_path / "manifest"))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    assert manifest.count() == manifest.select("path").distinct().count() == 601
    deliveries.check_raw(spark, str(tmp_path / "raw"), DAY, manifest)
    rows = deliveries.read_raw(spark, str(tmp_path / "raw"), DAY, ["payments.csv"])["payments.csv"]
    assert sorted(int(r.payment_id) for r in rows.collect()) == list(range(600))


def test_parts_with_other_headers_are_parsed_by_their_own(spark, tmp_path):
    folder = tmp_path / "in" / "payments.csv"
    os.makedirs(folder)
    names = HEADER.split(",")
    for i in range(9):
        order = names if i % 3 else [*reversed(names), "channel"]
        values = {**dict.fromkeys(names, ""), "payment_id": str(i), "payment_type": '"a,b"', "channel": "web"}
        lines = [",".join(order), ",".join(values[c] for c in order), "", "cut,off"]
        (folder / f"p {i}.csv").write_text("\r\n".join(lines) + "\r\n")
    files, _ = deliveries.list_files(spark, str(tmp_path / "in"))
    deliveries.copy_to_raw(spark, files, str(tmp_path / "raw"), DAY).write.parquet(str(tmp_path / "m"))
    scan = deliveries.scan_raw(spark, str(tmp_path / "raw"), DAY, ["payments.csv"])["payments.csv"]
    rows = deliveries.well_formed(scan)
    assert sorted((r.payment_id, r.payment_type, r.channel, r.claim_id) for r in rows.collect()) == [
        (str(i), "a,b", None if i % 3 else "web", None) for i in range(9)
    ]
    bad = deliveries.quarantine(scan, "payments.csv", DAY).collect()
    assert len(bad) == len({r.file for r in bad}) == 9 and {r.line.strip() for r in bad} == {"cut,off"}


def test_store_settings_reach_the_tasks(spark):
    from pyarrow import fs

    settings = {"endpoint": "localhost:1", "access.key": "a", "secret.key": "b", "connection.ssl.enabled": "false"}
    store, name = deliveries._open("s3a://bucket/a b/c.csv", settings)
    assert isinstance(store, fs.S3FileSystem) and name == "bucket/a b/c.csv" and store.region == "us-east-1"
    assert deliveries._open("file:/tmp/a%20b")[1] == "/tmp/a%20b"


def test_a_file_without_line_ends_is_refused(spark, tmp_path, monkeypatch):
    path = put(str(tmp_path), "payments.csv", "x" * 300_000)
    monkeypatch.setattr(deliveries, "HEADER_BYTES", 100_000)
    with pytest.raises(deliveries.ContractError, match="no end of the header"):
        deliveries._first_line(path)
