"""The whole job over several days: load, recover, re-run, idempotence."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from contentlake.functions.text import snake_case
from contentlake.operators.watermark import REGISTRY_SCHEMA
from contentlake.plans.daily import Sheets, read_gold, run_daily
from contentlake.sources.landing import read_landing
from contentlake.specs import PRODUCTION, VIDEO

VIDEO_HEADER = [
    "Tanggal", "Waktu", "Toko", "Nama Kreator", "ID Kreator", "Informasi Video", "ID Video",
    "Produk", *VIDEO.numeric_columns, *VIDEO.percent_columns, "Diagnosis", "Toko",
]


def video_row(day, shop, video, views="10", creator="7"):
    cells = {c: "1" for c in VIDEO.numeric_columns} | {c: "1,5%" for c in VIDEO.percent_columns}
    cells |= {
        "Tanggal": day, "Waktu": "", "Toko": shop, "Nama Kreator": " Ani ",
        "ID Kreator": creator, "Informasi Video": "x", "ID Video": video, "Produk": "p",
        "VV": views, "Diagnosis": "d",
    }
    row = [cells[c] for c in VIDEO_HEADER[:-1]]
    return [*row, "second"]


PRODUCTION_HEADER = ["Tanggal", "Tanggal Jadi", *PRODUCTION.text_columns, "Kode"]


def production_row(day, account, content, scripter="ann"):
    cells = {c: c for c in PRODUCTION.text_columns}
    cells |= {"akun": account, "id_konten": content, "scripter": scripter}
    return [day, "", *[cells[c] for c in PRODUCTION.text_columns], "k"]


def land(tmp, name, sheets, header, header_row):
    path = tmp / f"{name}.json"
    with path.open("w") as f:
        for sheet, rows in sheets.items():
            lines = [["title"]] * header_row + [header] + rows
            for i, cells in enumerate(lines):
                f.write(json.dumps({"sheet_name": sheet, "row_idx": i, "cells": cells}) + "\n")
    return str(path)


@pytest.fixture()
def lake(spark, tmp_path):
    registry = spark.createDataFrame(
        [("one", "c1", 0), ("two", "c2", 1), ("produksi", "cp", 2)], REGISTRY_SCHEMA
    )
    root = str(tmp_path / "lake")

    def run(day, video, production, run_id=None, hour=6):
        sheets = {
            "video": Sheets(
                read_landing(spark, land(tmp_path, f"v{day}{hour}", video, VIDEO_HEADER, 2)), registry
            ),
            "produksi": Sheets(
                read_landing(
                    spark,
                    land(tmp_path, f"p{day}{hour}", {"produksi": production}, PRODUCTION_HEADER, 0),
                ),
                registry,
            ),
        }
        return run_daily(
            spark, root, sheets, datetime(2024, 3, day, hour), run_id or f"{tmp_path.name}-{day}-{hour}"
        )

    run.root = root
    return run


def rows(spark, path, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def actions(reports, name):
    return {r["action"]: r["n_rows"] for r in reports[name].collect()}


def test_three_days(spark, lake):
    one = [
        video_row("2024-01-05", "shop", "v1", "1.000"),
        video_row("06/01/2024", "shop", "v2", "12%"),  # corrupt number
        video_row("2024-01-06", " Shop ", "v3", "5"),
        video_row("-", "-", "-"),  # bad date
        video_row("", "shop", "v9"),  # no id: gone before validation
    ]
    two = [video_row("2024-01-07", "other", "v4", "7")]
    prod = [production_row("2024-01-01", "acc", "V1"), production_row("TBD", "acc", "v2")]

    reports = lake(1, {"one": one, "two": two}, prod)
    r = reports["video"].first()
    assert (r["n_bad_rows"], r["n_date_errors"], r["n_blank_rows"]) == (2, 1, 0)
    assert r["affected_columns"] == ["VV", "Tanggal"]
    assert actions(reports, "merge_video") == {"insert": 3}
    assert actions(reports, "merge_produksi") == {"insert": 1}
    gold = sorted(tuple(r) for r in read_gold(spark, lake.root).select("id_video", "toko", "views", "scripter").collect())
    assert gold == [
        ("V1", "SHOP", 1000, "ANN"),
        ("V3", "SHOP", 5, None),
        ("V4", "OTHER", 7, None),
    ]
    bad = rows(spark, f"{lake.root}/manifest_values/video", "error_date", "bad_value")
    assert ("2024-01-06", "12%") in bad

    # Day 2: v2 is repaired, but its day also had the good row v3, so the count of valid
    # rows differs from n_rows and the entry stays open; v5 is past the mark.
    one[1] = video_row("06/01/2024", "shop", "v2", "12")
    one.append(video_row("2024-01-08", "shop", "v5", "9"))
    reports = lake(2, {"one": one, "two": two}, prod)
    assert reports["video"].first()["recovery_resolved"] == 0
    # Snapshots of the last merged day are looked at again, so that two runs a day work.
    assert actions(reports, "merge_video") == {"insert": 1, "unchanged": 3}

    # Day 3: production row v2 gets a date at or before the mark and is alone on it ...
    prod[1] = production_row("2024-01-01", "acc", "v2")
    reports = lake(3, {"one": one, "two": two}, prod)
    # ... but its open entry has no readable date and can never be confirmed.
    assert reports["produksi"].first()["recovery_resolved"] == 0
    assert "merge_produksi" in reports


def test_recovery_bypasses_the_mark(spark, lake):
    good = video_row("2024-01-09", "shop", "v1")
    broken = video_row("2024-01-05", "shop", "v2", "IDR")
    lake(1, {"one": [good, broken]}, [])
    fixed = video_row("2024-01-05", "shop", "v2", "3")
    reports = lake(2, {"one": [good, fixed]}, [])
    r = reports["video"].first()
    assert (r["recovery_resolved"], r["recovery_recovered_rows"]) == (1, 1)
    assert rows(spark, f"{lake.root}/silver/video", "id_video", "vv") == [("V1", 10), ("V2", 3)]
    fixes = rows(spark, f"{lake.root}/fixes/video", "error_date", "status")
    assert fixes == [("2024-01-05", "fixed")]

    # Nothing new: no bronze, no merge rows, manifest stays empty.
    before = rows(spark, f"{lake.root}/bronze/video", "row_hash_raw", "run_id")
    reports = lake(3, {"one": [good, fixed]}, [])
    assert rows(spark, f"{lake.root}/bronze/video", "row_hash_raw", "run_id") == before
    assert rows(spark, f"{lake.root}/silver/video", "id_video", "vv") == [("V1", 10), ("V2", 3)]


def test_repeated_run_changes_nothing(spark, lake):
    day1 = {"one": [video_row("2024-01-05", "shop", "v1"), video_row("2024-01-05", "shop", "v1")]}
    lake(1, day1, [], run_id="repeated")
    def counts():
        tables = ("bronze/video", "silver/video")
        return [*[spark.read.parquet(f"{lake.root}/{t}").count() for t in tables], read_gold(spark, lake.root).count()]

    assert counts() == [1, 1, 1]
    assert lake(1, day1, [], run_id="repeated") == {}
    assert counts() == [1, 1, 1]


def test_null_shop_is_inserted_again(spark, lake):
    lake(1, {"one": [video_row("2024-01-05", "", "v1")]}, [])
    reports = lake(2, {"one": [video_row("2024-01-05", "", "v1")]}, [])
    assert actions(reports, "merge_video")["insert"] == 1
    assert rows(spark, f"{lake.root}/silver/video", "id_video") == [("V1",), ("V1",)]


def test_header_names():
    assert snake_case("Nama Kreator") == "nama_kreator"
