"""Benchmark items that are too short for anchored windows."""

from __future__ import annotations

import random

import numpy as np
from test_operators import plain_edit

from quern.llm import decontaminate

HOST = "some words that stand before it"


def found_in(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = decontaminate.leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id): r.distance for r in out.collect()}


def test_short_items_next_to_marks_and_with_edits(spark):
    items = ["what is the capital of france", "cat sat"]
    texts = [f'{HOST} "{items[0]}" and more', f"{HOST}, {items[0]}, and", f"({items[0]})", f"{HOST} {items[0].replace('capital', 'capitol')} too", f"{HOST} whatis the capital of frnce", "a (cat sat)", "concat saturday", "nothing of it here"]
    assert found_in(spark, items, texts) == {(0, 0): 0, (1, 0): 0, (2, 0): 0, (3, 0): 1, (4, 0): 2, (5, 1): 0}


def test_every_short_item_within_its_edits_is_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    items, texts, distance = [], [], []
    for k in range(150):
        item = " ".join(word() for _ in range(20))[: 12 + k % 68].strip()
        body = list(item)
        for _ in range(int(decontaminate.EDIT_SHARE * len(item))):
            at = rng.randrange(len(body))
            body[at] = rng.choice(["", "x", body[at] + "q"])
        host = [word() for _ in range(60)]
        items.append(item)
        texts.append(" ".join([*host[:30], "".join(body), *host[30:]]))
    found = found_in(spark, items, texts)
    for k, item in enumerate(items):
        nearest = plain_edit(item.encode(), decontaminate.normalised(texts[k]))
        distance.append(nearest <= decontaminate.EDIT_SHARE * len(item))
        assert found.get((k, k)) == nearest
    assert all(distance)


def test_items_without_a_fitting_anchor(spark):
    item = "x" * 60 + "abcdefgh" * 5 + " end of it"
    assert found_in(spark, [item], [f"{HOST} {item[:70]}z{item[71:]} more"]) == {(0, 0): 1}
    index = decontaminate.Items([(0, ("one " * 5 + "two three four five six " * 6).strip().encode())])
    assert 0 in np.asarray(index.offset)


def test_one_boundary_rule_for_all_sizes(spark):
    """A letter that adjoins an item counts as an edit, whatever the item's size."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    items = []
    for size in (79, 80, 81, 120):
        item = " ".join(word() for _ in range(60))[:size]
        items.append(item[:-1] + "z" if item[-1] == " " else item)
    most = [int(decontaminate.EDIT_SHARE * len(x)) for x in items]
    texts = [f"{HOST} q{x}q and more" for x in items]
    # as many edits as the item may have, and then two letters more
    for x, n in zip(items, most, strict=True):
        body = list(x)
        body[-n - 3 : -3] = "9" * n
        texts += [f"{HOST} {''.join(body)} and more", f"{HOST} q{''.join(body)}q and more"]
    found = found_in(spark, items, texts)
    for k in range(len(items)):
        assert found.get((k, k)) == 0
        assert ((4 + 2 * k, k) in found, (5 + 2 * k, k) in found) == (True, False)
