"""The structural scan of JSON, chunk by chunk, against a plain reader."""

import json
import random

from cardloom.sources import json_scan


def scanned(text, cut_at, wrapped=False):
    """The elements by way of chunks that end after closing braces."""
    data, chunks, begin = text.encode(), [], 0
    for i in range(len(data)):
        if data[i : i + 1] == b"}" and cut_at():
            chunks.append(data[begin : i + 1])
            begin = i + 1
    chunks.append(data[begin:])
    states, whole = json_scan.compose([json_scan.summary(c) for c in chunks], wrapped)
    parts, order = {}, []
    for number, (chunk, state) in enumerate(zip(chunks, states, strict=True)):
        for place, (part, from_before, goes_on, name) in enumerate(json_scan.split(chunk, state)):
            if state.base == 2 and name is None:
                continue
            key = (state.since, "open") if from_before and not goes_on else (number, "open") if goes_on and not from_before else (state.since, "open") if goes_on else (number, place)
            if key not in parts:
                order.append(key)
            parts[key] = (name, parts.get(key, (name, b""))[1] + part)
    return [(name, part.decode().strip(" \t\r\n,\ufeff")) for name, part in (parts[k] for k in order) if part.decode().strip(" \t\r\n,\ufeff")], whole


def some_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 4 else 5)
    odd = '{}[],:" \\\\"\n\té x'
    if kind < 3:
        return "".join(rng.choice(odd) for _ in range(rng.randrange(9)))
    if kind < 5:
        return rng.choice([None, True, 1, -2.5e7])
    if kind == 5:
        return [some_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(odd) + f"k{i}": some_value(rng, depth + 1) for i in range(rng.randrange(4))}


def test_arrays_in_any_chunks():
    rng = random.Random(4)
    for turn in range(400):
        values = [some_value(rng) if rng.random() < 0.3 else {"a": some_value(rng), "b": some_value(rng)} for _ in range(rng.randrange(6))]
        layout = rng.choice([{}, {"indent": 2}, {"indent": 0}, {"separators": (",", ":")}, {"ensure_ascii": False}])
        text = rng.choice(["", "\ufeff", " \n"]) + json.dumps(values, **layout) + rng.choice(["", "\n"])
        found, whole = scanned(text, lambda: rng.random() < rng.choice([0.1, 0.5, 1]))
        assert whole and [json.loads(x) for _, x in found] == values, (turn, text)


def test_records_without_brackets():
    rng = random.Random(5)
    for between in ("\n", ",\n", " ", ""):
        values = [{"a": some_value(rng)} for _ in range(30)]
        found, whole = scanned(between.join(map(json.dumps, values)), lambda: rng.random() < 0.5)
        assert whole and [json.loads(x) for _, x in found] == values


def test_lists_under_keys():
    rng = random.Random(6)
    for turn in range(200):
        lists = {k: [{"i": i, "v": some_value(rng)} for i in range(rng.randrange(5))] for k in rng.sample(["data", "product", "other"], 2)}
        document = {"before": some_value(rng), **lists, "after": {"data": {"x": [1, {"y": 2}]}}}
        found, whole = scanned(json.dumps(document, indent=rng.choice([None, 1])), lambda: rng.random() < 0.5, wrapped=True)
        assert whole, turn
        for name, values in lists.items():
            assert [json.loads(x) for k, x in found if k == name] == values, turn


def test_broken_records_end_where_a_line_begins_the_next():
    rng = random.Random(7)
    for _ in range(100):
        values = [{"a": some_value(rng), "b": [{"c": 1}]} for _ in range(20)]
        indent = rng.choice([None, 2])
        texts = [json.dumps(v, indent=indent).replace("\n", "\n  ") for v in values]
        broken = set(rng.sample(range(20), 4))
        # cut off before the last character, or with a string left open
        texts = [(t[:-1] if rng.random() < 0.5 else t[:-1] + '"') if i in broken else t for i, t in enumerate(texts)]
        found, whole = scanned("[\n  " + ",\n  ".join(texts) + "\n]", lambda: rng.random() < 0.5)
        assert not whole
        good = []
        for _, x in found:
            try:
                good.append(json.loads(x))
            except ValueError:
                pass
        assert good == [v for i, v in enumerate(values) if i not in broken]
        assert len(found) == 20
