"""The corpus pipeline as a whole, stage by stage against brute force on a fixture with planted rows."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from contentlake.llm.token_output import WordEncoder
from contentlake.sources.files import exists

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PLAIN = """time year people way day man thing woman life child world school state family student group country problem hand
part place case week company system program question work government number night point home water room mother area money
story fact month lot right study book eye job word business issue side kind head house service friend father power hour game
line end member law car city community name president team minute idea kid body information back parent face others level
office door health person art war history party result change morning reason research girl guy moment air teacher force""".split()
COLUMNS = "doc_id long, text string, lang string, source string, _row string, _key int"


def say(seed: int, n: int) -> list[str]:
    return [PLAIN[i] for i in np.random.default_rng(seed).integers(0, len(PLAIN), n)]


def fingerprint(text: str | None) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def planted() -> tuple[list[tuple], list[tuple]]:
    item = say(999, 40)
    rows = [(i, " ".join(say(i, 120 + i % 50)), "en", f"s{i % 4}", "z", 1) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s0", "y", 2) for i in range(10)]  # copies
    near = rows[20][1].split()
    near[60] = "changed"
    rows += [(200, " ".join(near), "en", "s1", "x", 3), (201, rows[3][1].capitalize(), "en", "s1", "x", 3)]
    rows += [(300, " ".join(say(300, 60) + item + say(301, 60)), "en", "s2", "w", 4)]  # a leak
    near_item = list(item)
    near_item[20] = "teacher" if item[20] != "teacher" else "force"
    rows += [(301, " ".join(say(302, 60) + near_item + say(303, 60)), "en", "s2", "w", 4)]  # a near one, below 0.8
    rows += [(400, None, None, None, None, None), (401, "", "en", "s0", "v", 5), (402, "too short", "en", "s0", "v", 5), (403, "bad " * 300, "en", "s3", "v", 5)]
    rows += [(None, " ".join(say(500, 130)), "en", "s3", "u", 6), (None, rows[5][1], "en", "s3", "u", 6), (None, " ".join(say(501, 130)), None, None, None, None)]
    rows += [(7, " ".join(say(502, 130)), "en", "s1", "t", 7), (7, rows[7][1], "en", "s1", "t", 7)]  # repeated ids
    rows += [(600, " ".join(say(600, 6_000)), "en", "s2", "s", 8)]  # very long
    return rows, [(1, " ".join(item)), (2, None), (3, "")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows, bench = planted()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def one_per_group(rows: list[tuple]) -> set[int]:
    """Places of the first row of each group of linked fingerprints."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    fp, root = [fingerprint(rows[k][1]) for k in order], list(range(len(rows)))
    for _ in order:
        for i, a in enumerate(fp):
            for j, b in enumerate(fp):
                if bin(a ^ b).count("1") <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    return {order[k] for k in set(root)}


def test_stages(spark, folder, tmp_path):
    docs, sf = spark.read.parquet(f"{folder}/documents.parquet"), folder
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[k] = list(map(tuple, docs.collect()))
    rows, _ = planted()
    # Quality: the base rules' failures are gone, plain prose stays as it was.
    failing = {400, 401, 402, 403}
    assert Counter(kept[0]) == Counter(r for r in rows if r[0] not in failing)
    # Near-duplicates: one row of each group.
    firsts = one_per_group(kept[0])
    assert len(kept[1]) == len(firsts) and not Counter(kept[1]) - Counter(kept[0])
    assert Counter(r[0] for r in kept[1]) == Counter(kept[0][k][0] for k in firsts)
    # Decontamination: the row that holds an item leaves; the near passage shares 31 of 41 shingles, below 0.8.
    want = [r for r in kept[1] if r[0] != 300]
    assert Counter(kept[2]) == Counter(want) and len(want) == len(kept[1]) - 1
    # Mixing: rows as they were, three times at most, the words of each source near its target.
    assert set(kept[3]) <= set(kept[2]) and max(Counter(kept[3]).values()) <= 3
    total = sum(len(r[1].split()) for r in kept[2])
    assert abs(sum(len(r[1].split()) for r in kept[3]) - total) < 0.05 * total


def test_run(spark, folder):
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    tok, start = WordEncoder(VOCABULARY).tokenizer, 0
    by_id = {}
    for r in planted()[0]:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        by_id.setdefault(r[0], set()).add((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for doc_id, at, n, crc in sorted(got, key=lambda r: r[1]):
        assert at == start and (n, crc) in by_id[doc_id]
        start += n
    ids = Counter(r[0] for r in got)
    assert not {300, 400, 401, 402, 403} & set(ids) and set(range(0, 60)) & set(ids)
    again = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    assert Counter(again) == Counter(got)


def test_scratch_of_earlier_stages_is_dropped(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    corpus_pipeline.near_duplicates(spark, docs, folder).write.parquet(f"{tmp_path}/a")
    before = list(corpus_pipeline._STAGED)
    assert before and all(exists(spark, p) for p in before)
    docs = spark.read.parquet(f"{tmp_path}/a")
    out = corpus_pipeline.mix(spark, docs, folder)
    assert not any(exists(spark, p) for p in before)
    assert out.count() > 0


def test_empty_documents(spark, folder, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
