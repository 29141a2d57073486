"""Decontamination: verbatim and re-parameterised questions, slot consistency, a plain search, edge cases."""

import random
import re

import pyarrow as pa

from pulsemart.llm import decontaminate, queries

QUESTION = (
    "Last week Alice bought 12 apples for 3 dollars each and gave 5 of the 12 apples to her neighbour Bob, "
    "so how much had Alice paid for the apples that she kept?"
)


def run(spark, texts, items):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in found})
    return found


def test_reparameterised_questions(spark):
    other = QUESTION.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "40").replace("3", "7").replace("5", "9")
    mixed = QUESTION.replace("gave 5 of the 12", "gave 5 of the 13").replace("had Alice", "had Carol")
    noise = "nothing to see in this text that only has common words and no question at all "
    found = run(spark, [QUESTION, noise + QUESTION.upper() + noise, noise + other, mixed, noise * 20, QUESTION[:60]], [QUESTION])
    # Of `mixed`, whole windows repeat the item word for word, whatever was changed further on.
    assert found.keys() == {(0, 0), (1, 0), (2, 0), (3, 0)}
    assert not found[(0, 0)].changed and found[(0, 0)].coverage == 1
    assert not found[(1, 0)].changed and found[(1, 0)].coverage > 0.9
    assert found[(2, 0)].changed and found[(2, 0)].coverage > 0.9
    assert 0 < found[(3, 0)].coverage < 1


def test_verbatim_whatever_the_case_of_plain_text(spark):
    item = "the quick brown fox jumps over the lazy dog while seven other animals are looking on"
    found = run(spark, [item.upper(), item.replace(" ", " \n "), f"({item}.)", item.replace("lazy", "tired")], [item])
    assert found.keys() == {(0, 0), (1, 0), (2, 0)}


def test_short_items_and_odd_rows(spark):
    texts = [None, "", " \n", "!!! ???", "what is the capital of this country", "word " * 200_000, "tie one two", "tie one two"]
    items = ["what is the capital of this country", None, "", "tie one two", "... !!!", "what is the capital of this country"]
    found = run(spark, texts, items)
    # An item of a few words is found where it is the whole document.
    assert found.keys() == {(4, 0), (4, 5), (6, 3), (7, 3)}
    assert run(spark, ["a tie one two", "TIE one, two!", "tie one three"], ["tie one two"]).keys() == {(1, 0)}
    docs = spark.createDataFrame([(None, items[0]), (None, items[0])], "doc_id long, text string")
    bench = spark.createDataFrame([(0, items[0])], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, bench).collect()] == [None]
    assert decontaminate.drop_contaminated(docs, bench).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 2


def test_query_against_plain_search(spark, sf_dir):
    """Every document that holds 14 words of an item in a row is found, no document without 10 is."""
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    def grams(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    got = {(r.doc_id, r.item_id) for r in queries.op9_decontaminate(spark, sf_dir).collect()}
    for n, holds in ((14, lambda found: found <= got), (10, lambda found: got <= found)):
        of = {}
        for i, w in items.items():
            for g in grams(w, n):
                of.setdefault(g, set()).add(i)
        found = {(d, i) for d, w in docs.items() for g in grams(w, n) for i in of.get(g, ())}
        assert found and holds(found)


def test_types():
    core, kind, capital, ends = decontaminate.word_kinds(pa.array(["12", "$3.50", "kg", "Twelve", "Anna,", "END.", "x"], pa.large_string()))
    assert kind.tolist() == [1, 1, 2, 1, 0, 0, 0]
    assert capital.tolist() == [False, False, False, True, True, False, False]
    assert ends.tolist() == [False, False, False, False, False, True, False]
    assert core.to_pylist()[1] == "3.50"


def test_a_conflict_takes_only_its_own_windows(spark):
    """A changed repetition of a number further on leaves the windows before it; a window in conflict does not count."""
    late = QUESTION.replace("of the 12", "of the 13")
    short = "if 7 red and 7 blue balls are put into the box"
    found = run(spark, [late, QUESTION, short.replace("7 red", "8 red"), short.replace("7", "8")], [QUESTION, short])
    assert found.keys() == {(0, 0), (1, 0), (3, 1)}
    assert 0 < found[(0, 0)].windows < found[(1, 0)].windows
    assert not found[(0, 0)].changed or found[(0, 0)].coverage < 1
    assert found[(3, 1)].changed


def test_exact_copies_in_any_case(spark):
    """Names at every thirteenth word, a text of numbers and units, and items of names: case and full stops do not matter."""
    named = " ".join("Then we met Anna" if i % 3 == 0 else "and went on to see what was there" for i in range(9))
    numbers = "5 kg 7 kg 9 kg 11 kg 13 kg 15 kg and 17 kg of it"
    people = "with Anna Berta Carla Dora Emma Frida Greta Hanna Ida Johanna Klara Lena"
    items = [named, numbers, people]
    copies = [f(t) for t in items for f in (str, str.lower, str.upper, str.title)]
    found = run(spark, [*copies, numbers.replace("7", "8"), "so they came. " + people.lower()], items)
    assert found.keys() == {(i, i // 4) for i in range(12)} | {(13, 2)}
    assert all(found[(i, i // 4)].coverage == 1 and not found[(i, i // 4)].changed for i in range(12))
    other = QUESTION.replace("12", "40").replace("3", "7")
    assert run(spark, [other.upper()], [QUESTION])[(0, 0)].changed


def test_names_at_the_start_of_a_sentence(spark):
    """Other names and numbers, where names stand only at starts of sentences; other questions are left alone."""
    items = [
        "Tom has 12 apples and eats 5 of them. How many remain?",
        "Tom buys 12 pens. Tom sells 5 pens. Tom keeps the rest. How many pens does the boy keep now?",
    ]
    change = {"Tom": "Ann", "12": "30", "5": "7"}
    texts = [re.sub("|".join(change), lambda m: change[m[0]], i) for i in items]
    noise = "Nothing to see here, this goes on and on and says little of any use to anybody. "
    more = [noise + texts[0] + " " + noise, noise + texts[1], items[0], items[1].upper(), noise * 3]
    # The same name must stay one name within a window, and another question is another question.
    more += [texts[1].split(" How")[0].replace("Ann sells", "Bob sells"), "Ann has 30 pears and sells 7 of them. Who buys more?"]
    found = run(spark, [*texts, *more], items)
    assert found.keys() == {(0, 0), (1, 1), (2, 0), (3, 1), (4, 0), (5, 1)}
    assert all(found[k].changed for k in [(0, 0), (1, 1), (2, 0), (3, 1)])
    assert not found[(4, 0)].changed and not found[(5, 1)].changed


def plain_template(text):
    """Words of a text as (core, type) with every capital as a name."""
    out = []
    for word in re.findall(r"[^\x20\x09-\x0D]+", text):
        bare = re.sub(r"^[^\w]+|[^\w]+$", "", word)
        if bare:
            core = bare.lower()
            number = re.fullmatch(r"\d[\d.,:/]*(st|nd|rd|th|s)?", core) or core in decontaminate.NUMBER_WORDS
            kind = "number" if number else "unit" if core in decontaminate.UNITS else "name" if re.match("[A-Z].*[a-z]", bare) else ""
            out.append((core, kind))
    return out


def test_reparameterised_items_by_brute_force(spark, sf_dir):
    """Benchmark items under other numbers and names, in the middle of documents: what a plain search over
    all windows finds is found, and documents without any common window are left alone."""
    some = random.Random(2)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(40).collect()]
    questions = [f"{n} had {a} coins and gave {b} of the coins to {m}. {n} then found some more in the garden." for n, m, a, b in
                 (("Tom", "Mia", 12, 5), ("Eva", "Max", 40, 9), ("Leo", "Ida", 77, 3))]
    items += [q.replace("coins", w) for q, w in zip(questions, ("coins", "marbles", "stamps"))]
    names = {"Tom": "Zed", "Eva": "Kim", "Leo": "Ned", "Mia": "Sue", "Max": "Bob", "Ida": "Ann"}
    docs = []
    for i, item in enumerate(items):
        other = re.sub(r"\d+", lambda m: str(1000 + int(m[0])), item)
        other = re.sub("|".join(names), lambda m: names[m[0]], other)
        docs.append(" ".join(some.choice(["lorem", "ipsum", "dolor"]) for _ in range(20)) + " " + other if i % 2 else "sit amet " * 20)

    def windows(text, length):
        words = plain_template(text)
        out = {}
        for at in range(len(words) - length + 1):
            own = words[at : at + length]
            if sum(not k for _, k in own) / length >= decontaminate.LITERAL:
                out.setdefault(tuple(k or c for c, k in own), []).append([c for c, k in own if k])
        return out

    def plain(doc, item):
        length = min(len(plain_template(item)), decontaminate.WINDOW)
        known, there = windows(item, length), windows(doc, length)
        pairs = ({*zip(a, b)} for t in known.keys() & there.keys() for a in known[t] for b in there[t])
        return any(len({a for a, _ in p}) == len({b for _, b in p}) == len(p) for p in pairs)

    want = {(d, i) for d, doc in enumerate(docs) for i, item in enumerate(items) if len(plain_template(item)) >= 5 and plain(doc, item)}
    found = run(spark, docs, items).keys()
    assert len(want) > 10 and want <= found
    assert all(d % 2 for d, _ in found)
