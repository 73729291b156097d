"""License scan: ranking against plain recomputation, wording differences, odd rows."""

import random

import zstandard

from fundlens.llm import licenses


def test_every_template_is_its_own_best_match():
    s = licenses.Scanner()
    for name, variants in licenses.TEMPLATES.items():
        for t in variants:
            got, reduction, missing, extra, confirmed = s.best(t)
            assert (got, missing, extra, confirmed) == (name, [], [], True) and reduction >= licenses.MIN_REDUCTION


def test_reduction_is_the_conditional_size():
    block = "Released under the MIT License."
    _, reduction, _, _, _ = licenses.Scanner().best(block)
    make = lambda **k: zstandard.ZstdCompressor(level=licenses.LEVEL, write_content_size=False, **k)
    alone = len(make().compress(block.encode()))
    raw = zstandard.ZstdCompressionDict(licenses.TEMPLATES["MIT"][0].encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    given = len(make(dict_data=raw, write_dict_id=False).compress(block.encode()))
    assert reduction == round(1 - given / alone, 6)


def test_changed_wording_is_reported():
    name, _, missing, extra, confirmed = licenses.Scanner().best("Licensed under the Apache Licence, Version 2.0.")
    assert name == "Apache-2.0" and missing == ["license"] and extra == ["licence"] and confirmed
    name, _, _, _, confirmed = licenses.Scanner().best("This licence text resembles nothing that is known to anyone here.")
    assert not confirmed


def test_blocks_of_whole_texts(spark):
    rng = random.Random(1)
    filler = "\n".join("plain words " * rng.randrange(1, 9) for _ in range(400))
    rows = [(1, f"{filler}\nLicensed under CC BY-NC 4.0.\n{filler}\nAll rights reserved."), (2, None), (3, ""), (4, filler),
            (None, "All rights reserved."), (5, "All rights reserved."), (5, "All rights reserved.")]
    df = spark.createDataFrame([(i, t, "l") for i, t in rows], "doc_id long, text string, license_id string")
    got = sorted(((r["doc_id"], r["first_line"], r["license_id"], r["confirmed"]) for r in licenses.scan(df).collect()), key=str)
    want = [(1, 400, "CC-BY-NC-4.0", True), (1, 801, "all-rights-reserved", True), (None, 0, "all-rights-reserved", True)]
    assert got == sorted(want + [(5, 0, "all-rights-reserved", True)] * 2, key=str)
    assert licenses.scan(df.where("false")).count() == 0
