import pytest
from pyspark.sql import functions as F

from loglathe.llm import decontaminate
from tests.conftest import MEDIUM

ITEMS = [
    (1, "A train leaves the station at 9 carrying 120 kg of coal for Anna. How many kg remain after Anna sells 45 kg of it?"),
    (2, "The committee decided yesterday that the old bridge over the river must be closed before the winter begins again."),
    (3, "yes no"),
    (4, None),
    (5, ""),
]


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def hits(docs, bench):
    return {r.doc_id: (r.item_ids, r.verbatim) for r in decontaminate.report(docs, bench).collect()}


def test_documents_equal_a_search_by_hand(spark):
    docs, bench = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda text: " ".join(text.lower().split())
    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    expected = {r.doc_id: sorted(i for i, t in items if t in plain(r.text)) for r in docs.collect()}
    assert {i: found for i, (found, _) in hits(docs, bench).items()} == expected


def test_new_values_are_caught_and_inconsistent_ones_are_not(frame, bench):
    same = "Intro words first. " + ITEMS[0][1] + " And more words."
    other = ITEMS[0][1].replace("120", "350").replace("45", "77").replace("Anna", "Boris").replace(" 9 ", " 11 ")
    mixed = ITEMS[0][1].replace("for Anna", "for Boris").replace("after Anna", "after Clara")
    half = " ".join(ITEMS[1][1].split()[:14])
    little = " ".join(ITEMS[1][1].split()[:8])
    shout = "Read this now:\n" + ITEMS[1][1].upper() + "\nThe end."
    docs = frame((1, same), (2, other), (3, mixed), (4, half), (5, little), (6, shout), (7, "The committee met. The old bridge is closed. Winter begins again."), (8, "yes no yes no"))
    got = hits(docs, bench)
    assert got[1] == ([1], True) and got[2] == ([1], False)
    assert got[4][0] == [2] and got[6][0] == [2]
    assert all(got[i] == ([], False) for i in (3, 5, 7, 8))


def test_two_items_and_repeats(frame, bench):
    both = f"{ITEMS[1][1]}\n{ITEMS[0][1]}\n{ITEMS[0][1].replace('120', '80')}"
    got = hits(frame((1, both), (1, both), (2, "clean text about nothing in particular and so on and on")), bench.union(bench))
    assert got == {1: ([1, 2], True), 2: ([], False)}
    # the same item again with other values: each alignment is judged alone


def test_odd_rows(odd_docs, no_docs, bench):
    rows = decontaminate.report(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count() and not any(r.contaminated for r in rows)
    assert decontaminate.report(no_docs, bench).collect() == []
    assert not any(r.contaminated for r in decontaminate.report(odd_docs, bench.limit(0)).collect())
    kept = decontaminate.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_slots():
    template = decontaminate.Template()
    _, _, slots = template.of("Then Anna paid 5 km and 3,000.50 for a day in May. Next 7 days")
    words = "Then Anna paid 5 km and 3,000.50 for a day in May. Next 7 days".split()
    assert [w for w, s in zip(words, slots, strict=True) if s] == ["Anna", "5", "km", "3,000.50", "May.", "7", "days"]


def found(docs, texts):
    items = docs.sparkSession.createDataFrame(list(enumerate(texts, 1)), "item_id bigint, text string")
    return {r.doc_id: r.item_ids for r in decontaminate.report(docs, items).collect()}


def test_two_values_may_become_one_and_a_conflict_costs_its_windows_only(frame):
    pens = "Yesterday my sister bought 3 pens and 5 books in the shop near our school."
    long = (
        "Anna walked along the river every morning before work because she liked the quiet water and the birds. One day Anna found "
        "a small wooden box under the bridge, and inside it lay an old letter that nobody had opened for many years. The letter was "
        "addressed to a person whom the whole village had long forgotten, so Anna kept it."
    )
    docs = frame(
        (1, pens.replace("3", "4").replace("5", "4")), (2, long.replace("day Anna", "day Clara")), (3, "My brother sold 4 cars and 4 boats at the sea."),
        (4, pens.replace("3 pens", "4 pens")),
    )
    assert found(docs, [pens, long]) == {1: [1], 2: [2], 3: [], 4: [1]}


def test_items_of_numbers_and_names_and_other_case(frame):
    numbers = "Sum 17 25 42 98 61 33 57 12 77 81 90 14 = ?"
    names = "Anna Boris and Clara met David Emma and Fred in Paris near Notre Dame with George Hanna and Ivan today."
    docs = frame((1, f"Sheet one. {numbers} Done."), (2, names.lower()), (3, names.upper()), (4, "Sum 18 26 43 99 62 34 58 13 78 82 91 15 = ?"))
    assert found(docs, [numbers, names]) == {1: [1], 2: [2], 3: [2], 4: []}


def test_short_items_below_headings(frame):
    capital, names, short = "What is the capital of France?", "Anna has 3 apples and 2 pears", "Name two primes."
    docs = frame(
        (1, f"Quiz page\n{capital}\nAnother line"), (2, "Quiz page\n- What is the capital of Spain?"), (3, "My list\nBoris has 7 apples and 4 pears"),
        (4, "Intro words\nname two primes\nmore"), (5, "please name two primes now"), (6, "First sentence. Name two primes. Last one."), (7, "What is the city of France?"),
    )
    assert found(docs, [capital, names, short]) == {1: [1], 2: [1], 3: [2], 4: [3], 5: [], 6: [3], 7: []}


def judged_by_hand(template, text, item):
    """One text against one item by comparing tokens at every alignment: share held, or 0."""
    t, m = template.tokens([text]), template.tokens([item])
    n, width = len(m.own), min(decontaminate.WINDOW, len(m.own))
    slots = m.slots[1]
    alls, clean, broken_all, same = set(), set(), set(), set()
    for shift in range(-n, len(t.own)):
        at = lambda p: p + shift
        own, tpl = set(), set()
        for p in range(n - width + 1):
            inside = range(p, p + width)
            if at(p) < 0 or at(p + width - 1) >= len(t.own):
                continue
            if all(t.own[at(q)] == m.own[q] for q in inside):
                own.add(p)
            for a in range(2):
                for b in range(2):
                    if all(t.shown[a][at(q)] == m.shown[b][q] for q in inside) and 0 < sum(m.slots[b][q] for q in inside) < width:
                        tpl.add((p, b))
        fills = {(q, int(m.own[q]), int(m.own[q])) for p in own for q in range(p, p + width) if slots[q]}
        fills |= {(q, int(m.own[q]), int(t.own[at(q)])) for p, b in tpl for q in range(p, p + width) if m.slots[b][q]}
        several = {a for _, a, b in fills if len({y for _, x, y in fills if x == a}) > 1}
        broken = {q for q, a, b in fills if a in several and a != b}
        kept = {p for p in own | {p for p, _ in tpl} if not any(p <= q < p + width for q in broken)}
        covered = {q for p in kept for q in range(p, p + width)}
        if covered:
            alls |= covered
            broken_all |= broken
            clean |= covered if not broken else set()
            mine = {q for q, a, b in fills if a == b}
            same |= covered - ({q for q, a, b in fills if a != b} - mine)
    if not alls or len(same) < decontaminate.MIN_OWN * len(alls):
        return 0
    return max(len(clean), len(alls) - len(broken_all - alls)) / n


def test_slot_matches_equal_a_search_by_hand(spark):
    """Items asked again with other values, consistent or not, cut, joined and mixed with other words."""
    import random

    rng = random.Random(11)
    words, names = [f"w{i}" for i in range(12)], ["Anna", "Boris", "Clara"]
    value = lambda: rng.choice([str(rng.randrange(1, 9)), rng.choice(names), f"{rng.randrange(2, 5)} kg", rng.choice("+-*=")])
    items = [" ".join(rng.choice(words) if rng.random() < 0.6 else value() for _ in range(rng.randint(9, 18))) for _ in range(12)]
    docs = []
    for i in range(160):
        item = rng.choice(items).split()
        change = {w: value().split()[0] if not w.startswith("w") and rng.random() < 0.7 else w for w in item}
        asked = [value().split()[0] if w not in words and rng.random() < 0.1 else change[w] for w in item]
        if rng.random() < 0.3:
            asked = asked[rng.randrange(len(asked)) :]
        if rng.random() < 0.3:
            asked.insert(rng.randrange(len(asked) + 1), rng.choice(words))
        noise = lambda: [rng.choice(words) if rng.random() < 0.8 else value() for _ in range(rng.randrange(9))]
        docs.append((i, " ".join([*noise(), *asked, *noise()])))
    template = decontaminate.Template()
    expected = {(i, j): judged_by_hand(template, text, item) for i, text in docs for j, item in enumerate(items)}
    expected = {k: v for k, v in expected.items() if v >= decontaminate.MIN_COVER}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.covered for r in decontaminate.matches(frame, bench).collect()}
    assert got == pytest.approx(expected) and 20 < len(got) < 400


def test_signs_are_tokens_beside_numbers(frame):
    asked = "What is 12 + 7 * 3 - 5 ?"
    docs = frame((1, "What is 15 + 9 * 2 - 4 ?"), (2, "What is 12 - 7 + 3 * 5 ?"), (3, f"Warm up.\n- {asked}"), (4, "List:\n- 5 apples\n- 7 pears"))
    assert found(docs, [asked]) == {1: [1], 2: [], 3: [1], 4: []}


def test_items_of_one_template_are_one_class(spark, monkeypatch):
    """Forty documents and three hundred items that differ in one number: a match row for each document."""
    items = [(i, f"A farmer sells {i} eggs on the market every morning and keeps the others for the family at home.") for i in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame([(i, items[i * 7][1]) for i in range(40)] + [(50, items[0][1].replace(" 0 ", " 1000 "))], "doc_id bigint, text string")
    got = decontaminate.matches(docs, bench).collect()
    assert {r.doc_id: (r.item_id, r.verbatim) for r in got} == {**{i: (i * 7, True) for i in range(40)}, 50: (0, False)}
    assert len(got) == 41
    classes = decontaminate.template_classes(bench).collect()
    assert len(classes) == 300 and len({r.kind for r in classes}) == 1


def test_clashing_columns_of_the_benchmark(spark, frame):
    item = "The quick brown fox jumps over the lazy dog near the old mill"
    names = ["kind", "width", "place", "hash", "slots", "tokens", "at", "groups", "is_own", "fills", "name", "row", "doc_id", "text_key"]
    bench = spark.createDataFrame([(1, item, *["x"] * len(names))], "item_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    docs = frame((1, f"Look: {item}.")).withColumns({n: F.lit("y") for n in names if n != "doc_id"})
    assert [(r.doc_id, r.item_ids) for r in decontaminate.report(docs, bench).collect()] == [(1, [1])]
