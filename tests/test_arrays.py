"""Array files cut into ranges of all sizes, against the json module."""

import json
import random

import pytest

from galewire.sources.arrays import array_elements
from galewire.sources.posts import read_posts

ODD = ["", "a\"b", "\\", "\\\\", "\\\"", "[", "]", "{,}", "é☃\U0001f600", ",\n", "]\\", "x" * 300, " ", "\t"]


def made(rng, n):
    def value(deep):
        kind = rng.randrange(6 if deep < 3 else 4)
        if kind == 4:
            return [value(deep + 1) for _ in range(rng.randrange(4))]
        if kind == 5:
            return {rng.choice(ODD): value(deep + 1) for _ in range(rng.randrange(4))}
        return rng.choice([rng.choice(ODD), rng.randrange(-99, 99), None, True, 1.5])

    return [{"id": str(k), "text": rng.choice(ODD) + rng.choice(ODD), "more": value(0)} for k in range(n)]


@pytest.mark.parametrize("chunk_bytes", [1, 7, 64, 1000, 1 << 20])
def test_elements_of_arrays(spark, tmp_path, chunk_bytes):
    rng = random.Random(chunk_bytes)
    want = []
    for k in range(4):
        rows = made(rng, rng.randrange(1, 8 if chunk_bytes < 64 else 120))
        want += rows
        text = json.dumps(rows, indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{k}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n"]))
    for name, text in (("none", "[]"), ("blank", " \n "), ("nothing", ""), ("spaced", " [ \n ] ")):
        (tmp_path / f"{name}.json").write_text(text)
    (tmp_path / "one.json").write_text(' {"id": "one", "text": "[,]"} ')
    want.append({"id": "one", "text": "[,]"})
    found = [json.loads(r.value) for r in array_elements(spark, str(tmp_path), chunk_bytes).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_a_bad_element_costs_itself_and_a_file_has_many_tasks(spark, tmp_path):
    good = [json.dumps({"id": str(k), "text": f"text {k}"}) for k in range(400)]
    bad = ['{"id": }', "oops", "7", "", "[1, 2]", "null"]
    mixed = [x for k, g in enumerate(good) for x in ([g, bad[k % 6]] if k % 50 == 0 else [g])]
    (tmp_path / "a.json").write_text("[" + ",\n".join(mixed) + "]")
    elements = array_elements(spark, str(tmp_path), 1024)
    assert elements.count() == len(mixed)
    assert sum(n > 0 for n in elements.rdd.glom().map(len).collect()) > 3
    rows = read_posts(spark, str(tmp_path), json_array=True, chunk_bytes=1024).collect()
    assert sorted(int(r.id) for r in rows if r._corrupt_record is None) == list(range(400))
    assert len([r for r in rows if r._corrupt_record is not None]) == 8
