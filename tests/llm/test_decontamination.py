import re

from newsloom.llm import decontamination


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute(docs, items):
    found = {}
    for d, text in docs:
        for i, item in items:
            want = shingles(item)
            if want and len(want & shingles(text)) >= 0.8 * len(want) - 1e-9:
                found[d, i] = max(found.get((d, i), 0), len(want & shingles(text)) / len(want))
    return found


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_by_brute_force(spark, awkward, empty):
    item = words("q", 24)
    items = [(1, item), (2, words("z", 9)), (3, "only three words"), (4, None), (5, ""), (6, item.upper() + "!"), (None, words("n", 12)), (7, words("c", 14))]
    docs = [
        (20, f"{words('a', 400)} {item} {words('b', 3000)}"),
        (21, f"{words('a', 40)}, {' '.join(item.split()[:20])} {words('b', 30)}"),
        (22, " ".join(item.split()[:19])),
        (23, f"{words('z', 9)} {item.replace(' ', chr(10))}"),
        (24, f"{words('n', 12)} x"),
        (25, words("c", 12)),
        (26, words("c", 11)),
    ] + [(r["doc_id"], r["text"]) for r in awkward.collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.find(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["containment"] for r in rows} == brute(docs, items)
    left = decontamination.decontaminate(frame, bench)
    gone = {d for d, _ in brute(docs, items)}
    assert sorted(map(str, [r["doc_id"] for r in left.collect()])) == sorted(str(d) for d, _ in docs if d not in gone)
    assert decontamination.decontaminate(awkward, bench).columns == awkward.columns
    assert decontamination.find(empty, bench).collect() == []
    assert decontamination.decontaminate(frame, bench.where("false")).count() == len(docs)


def test_sketches_grow_with_the_size_class(spark):
    items = spark.createDataFrame([(n, words("w", n + 4)) for n in (1, 2, 10, 11, 40)], "item_id long, text string")
    made = {r["item_id"]: (r["size_class"], len(r["sketch"])) for r in decontamination.item_sketches(items).collect()}
    assert made == {1: (1, 1), 2: (2, 1), 10: (16, 4), 11: (16, 4), 40: (64, 13)}


def test_clean_rows_stay_where_another_row_of_their_id_leaks(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, item), (None, "clean words of a text without an id"), (1, item), (1, "clean words of a repeated id"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontamination.decontaminate(docs, items).collect()
    assert sorted(str(r["text"]) for r in kept) == ["None", "clean words of a repeated id", "clean words of a text without an id"]


def test_items_below_five_words_are_found_inside_longer_texts(spark):
    items = spark.createDataFrame([(1, "blue whale"), (2, "Rare"), (3, "a b c d"), (4, words("q", 9))], "item_id long, text string")
    docs = [(1, "the blue whale swims far away today"), (2, "blue whale"), (3, "a blue, whale!"), (4, "whale blue"), (5, "x a b c d e f g"), (6, "a b c"), (7, "so rare a thing"), (8, words("q", 9))]
    rows = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in rows) == [(1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1), (5, 3, 1, 1), (7, 2, 1, 1), (8, 4, 5, 5)]
