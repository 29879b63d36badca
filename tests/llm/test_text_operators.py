"""Licences, fingerprints, passages, templates: small fixtures and brute force."""

from __future__ import annotations

import hashlib

import pytest

from boreline.llm import decontam, fingerprint, licenses, linededup, substring


def test_licenses(spark, docs):
    rows = [
        (1, "Copyright (c) 2020 Somebody\r\n\r\n" + licenses.MIT_GRANT.upper().replace("SUBLICENSE", "sub-licence")),
        (2, None),
        (3, ""),
        (4, "Text.\nReleased under the MIT Licence!\nMore. v"),
        (5, "intro\n\n" + licenses.ISC_GRANT + "\n\nend"),
        (6, licenses.APACHE_NOTICE.split("\n\n")[0]),
        (7, licenses.MIT_GRANT.replace("free of charge", "for money")),
        (8, "All rights reserved.\n" * 3),
        (8, "All rights reserved.\n" * 3),
        (9, "... !!!"),
    ]
    got = [(r.doc_id, r.license, r.blocks, r.block_licenses) for r in licenses.scan(docs(rows)).orderBy("doc_id").collect()]
    reserved = "LicenseRef-all-rights-reserved"
    assert got == [(1, "MIT", 2, "MIT"), (2, None, 0, ""), (3, None, 0, ""), (4, None, 1, "MIT"), (5, None, 1, "ISC"), (6, None, 0, ""), (7, None, 0, ""), (8, None, 3, reserved), (8, None, 3, reserved), (9, None, 0, "")]
    assert licenses.scan(docs([])).count() == 0
    plan = licenses.scan(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_canonical_spellings_meet(spark):
    df = spark.createDataFrame([("Licences, LICENCE licence; v 2 © x",), ("licenses license license version 2 x",)], "t string")
    assert df.select(licenses.canonical(df.t)).distinct().count() == 1


def test_fingerprints_follow_the_order(spark, docs, odd_rows):
    rows = fingerprint.compare_with_next(docs(odd_rows)).collect()
    named = sorted(((k, t or "") for k, t in odd_rows if k is not None), key=lambda r: (-r[0], hashlib.sha256(r[1].encode()).hexdigest()))
    ordered = [*named, (None, "one two three")]
    want = set()
    for k, (key, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = [fingerprint.fingerprint(t) for t in (text, changed, following)]
        want.add((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1], fingerprint.likeness(prints[0], prints[1]), fingerprint.likeness(prints[0], prints[2])))
    assert len(rows) == len(odd_rows) and set(map(tuple, rows)) == want
    assert fingerprint.compare_with_next(docs([])).count() == 0
    (alone,) = fingerprint.compare_with_next(docs([(5, "abcdef")])).collect()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_fingerprints_over_many_ranges(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(df.select("doc_id", "text").collect())
    keys = sorted(texts, reverse=True)
    got = {r.doc_id: r.edited_sha256 for r in fingerprint.op6_fingerprints(spark, sf_dir).collect()}
    assert got == {k: hashlib.sha256(fingerprint.edited(texts[k], texts[keys[(n + 1) % len(keys)]]).encode()).hexdigest() for n, k in enumerate(keys)}


def test_likeness_tells_edits_from_others(spark, sf_dir):
    rows = fingerprint.op6_fingerprints(spark, sf_dir).where("n_chars > 200").collect()
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.97 * len(rows)
    assert all(0 <= v <= 1 for r in rows for v in (r.near_edited, r.near_next))


def test_parts_count_like_the_whole():
    data = bytes(range(256)) * 3000
    whole = fingerprint.counts(data)
    fingerprint.PART, kept = 1000, fingerprint.PART
    try:
        assert (fingerprint.counts(data) == whole).all()
    finally:
        fingerprint.PART = kept


PASSAGE = "this passage of many words was put into two documents. it has a second sentence that is long enough too, and goes on for a while. and a third one which ends here with some more words than before."


def sentences(text):
    """Spans of the sentences of every line, character by character."""
    out, start = [], None
    for k, c in enumerate(text + "\n"):
        if start is None:
            if not c.isspace():
                start = k
        elif c == "\n":
            out.append((start, k))
            start = None
        if start is not None and c in ".!?" and (text + "\n")[k + 1].isspace() or start is not None and c in "\u3002\uff01\uff1f" and (text + "\n")[k + 1] not in "\u3002\uff01\uff1f":
            out.append((start, k + 1))
            start = None
    return out


def passages_by_hand(rows, least=substring.MIN_CHARS):
    """(key, start, end, first key) of the runs of sentences that stand elsewhere before."""
    places = {}
    for key, text in sorted(set(rows)):
        for n, (a, b) in enumerate(sentences(text)):
            places.setdefault(" ".join(text[a:b].lower().split()), []).append((key, a, b, n))
    out = set()
    for key, text in set(rows):
        run = []
        for a, b in [*sentences(text), (None, None)]:
            unit = a is not None and " ".join(text[a:b].lower().split())
            first = unit is not False and min(places[unit])
            if unit is not False and first[:2] != (key, a):
                run.append((a, b, len(unit), first[0]))
            elif run:
                if sum(r[2] for r in run) + len(run) - 1 >= least:
                    out.add((key, run[0][0], run[-1][1], run[0][3]))
                run = []
    return out


def test_passages(spark, docs, odd_rows):
    verse = "\n".join(f"line {k} of a verse\nis short" for k in range(9))
    chinese = "\u8fd9\u662f\u4e00\u4e2a\u6bb5\u843d" * 30
    rows = [(1, f"Intro one\n{PASSAGE}\nend"), (2, f"other words before {PASSAGE} and more behind it"), (3, f"A line\n{PASSAGE.upper()}"), (4, "short line\nshort line"), (4, "short line\nshort line"), (5, PASSAGE.replace(" ", "   ")), (5, PASSAGE.replace(" ", "   ")), (None, PASSAGE)]
    rows += [(6, verse), (7, f"before\n{verse}\nafter"), (8, chinese), (9, f"x\n{chinese}"), (10, "it has a second sentence that is long enough too, and goes on for a while."), (11, None), (12, "")]
    got = substring.repeated_passages(docs(rows)).collect()
    texts = {k: t for k, t in rows if k is not None and t}
    assert {(r.doc_id, r.start, r.end, r.first_doc_id) for r in got} == passages_by_hand(list(texts.items()))
    found = {r.doc_id: texts[r.doc_id][r.start : r.end] for r in got}
    assert set(found) == {2, 3, 5, 7, 9} and found[7] == verse and found[9] == chinese and found[2].startswith("it has") and found[2].endswith("before.")
    assert {r.doc_id: r.units for r in got}[3] == 3
    cut = {r.doc_id: r.text for r in substring.without_passages(docs(rows), substring.repeated_passages(docs(rows))).collect()}
    assert cut[1] == texts[1] and cut[3] == "A line\n" and cut[7] == "before\n\nafter" and cut[11] is None and "second sentence" not in cut[2] and cut[10] == texts[10]
    assert substring.repeated_passages(docs([])).count() == 0
    odd = [(k, t) for k, t in odd_rows if k is not None and t]
    assert {(r.doc_id, r.start, r.end, r.first_doc_id) for r in substring.repeated_passages(docs(odd_rows)).collect()} == passages_by_hand(odd)


def test_rows_of_one_key_are_told_apart(spark, docs):
    rows = [(1, PASSAGE), (2, f"own words here\n{PASSAGE}"), (2, f"none of it here, but words of the same number\n{PASSAGE}\nend")]
    cut = sorted(r.text for r in substring.without_passages(docs(rows), substring.repeated_passages(docs(rows))).collect())
    assert cut == ["none of it here, but words of the same number\n\nend", "own words here\n", PASSAGE]


def test_passages_are_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {(r.doc_id, r.start, r.end, r.first_doc_id) for r in substring.op7_substring(spark, sf_dir).collect()}
    assert got == passages_by_hand(rows) and got


ITEM = "Anna buys 12 apples for 3 dollars in Paris and then sells 5 apples for 20 dollars, how much money is left for Anna?"


def leaks(spark, docs, rows, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs(rows), bench).collect()}


def test_templates(spark, docs, odd_rows):
    other = ITEM.replace("12", "40").replace("Paris", "Rome").replace("20 dollars", "90 dollars").replace("5 apples", "7 apples").replace("3 dollars", "2 dollars").replace("Anna", "Maria")
    mixed = ITEM.replace("12", "5").replace("20", "5").replace("for 3", "for 5").replace("Paris", "Anna")
    rows = [(1, "Some words before. " + ITEM), (2, "Intro; " + other + " More."), (3, "nothing of this kind is here at all"), (4, ITEM[:40]), (5, "Text. " + mixed), (6, ITEM), (6, ITEM)]
    got = leaks(spark, docs, rows, [(1, ITEM), (2, None), (3, "too short"), (None, ITEM)])
    assert set(got) == {(1, 1), (2, 1), (6, 1)}
    assert got[1, 1].share == 1.0 and got[2, 1].consistent == 1.0
    assert leaks(spark, docs, odd_rows, [(1, ITEM)]) == {} and leaks(spark, docs, rows, []) == {} and leaks(spark, docs, [], [(1, ITEM)]) == {}


REPEATING = "Tom has 3 red balls and Anna has 4 red balls and Maria has 5 red balls and Peter has 6 red balls. How many red balls do they have in all?"


def test_copies_are_judged_by_region(spark, docs):
    other = ITEM.replace("12", "40").replace("Paris", "Rome").replace("20 dollars", "90 dollars").replace("5 apples", "7 apples").replace("3 dollars", "2 dollars").replace("Anna", "Maria")
    third = ITEM.replace("12", "8").replace("Paris", "Oslo").replace("20 dollars", "11 dollars").replace("5 apples", "6 apples").replace("3 dollars", "9 dollars").replace("Anna", "Peter")
    jumbled = REPEATING.replace("3 ", "7 ").replace("4 ", "7 ").replace("5 ", "7 ").replace("6 ", "7 ").replace("Anna", "Tom").replace("Maria", "Tom").replace("Peter", "Tom")
    rows = [(1, REPEATING), (2, f"{ITEM} {other} {third}"), (3, "Text. " + REPEATING.replace("3", "8").replace("Anna", "Eva")), (4, jumbled), (5, "no item")]
    got = leaks(spark, docs, rows, [(1, ITEM), (2, other), (9, REPEATING)])
    assert set(got) == {(1, 9), (2, 1), (2, 2), (3, 9)}
    assert got[1, 9].share == 1.0 and got[1, 9].consistent == 1.0


def test_short_items_and_long_runs(spark, docs):
    question = "What colour do most people see when they look up there"
    tiny, names = "Why so blue?", "Tom 3 Anna 4 Eva 5 Max 6 Ida 7"
    words = [f"{a}{b}o" for a in "bcdfghjklmnpqrs" for b in ("a", "e", "i", "ou", "ay", "ee", "ar", "or", "an", "en", "in", "on", "ul", "al")][:200]
    rows = [(1, f"A heading {question}"), (2, f"A heading\n{question}"), (3, question.replace("people", "animals")), (4, "they asked why so blue and left"), (5, f"list {names} end"), (6, "Before. " + " ".join(words[60:150])), (7, "What colour do most birds have"), (8, " ".join(words[60:80])), (9, "so why blue"), (10, "Ida 3 Max 4 Eva 5 Anna 6 Tom 7")]
    got = leaks(spark, docs, rows, [(1, question), (2, tiny), (3, names), (4, " ".join(words))])
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 4)}
    assert (got[4, 2].first_word, got[4, 2].last_word) == (2, 4) and got[1, 1].share == 1.0


def test_contained_items_are_found(spark, sf_dir):
    """Every document that holds an item's text, and no other."""
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in texts for i, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in decontam.op8_decontamination(spark, sf_dir).collect()}
    assert want <= got
    words = {i: {tuple(w[k : k + 5]) for w in [x.lower().split()] for k in range(len(w) - 4)} for i, x in items}
    for d, i in got - want:
        w = dict(texts)[d].lower().split()
        assert len(words[i] & {tuple(w[k : k + 5]) for k in range(len(w) - 4)}) >= 0.4 * len(words[i])


@pytest.mark.parametrize("word", ["12", "3.5", "$40", "20%", "1,000", "12:30"])
def test_numbers(word):
    assert decontam.Tokens()[word][1] & 2


def test_line_templates(spark, docs, odd_rows):
    rows = [(k, f"{chr(97 + k)}own {chr(98 + k)}words here {chr(99 + k)}ly\nUser {'xyz'[k % 3] * (k + 1)} logged in from host h{k} at noon\nunique tail {chr(97 + k)} of text") for k in range(12)]
    rows += [(100, "User a logged in from host b at noon"), (101, None), (102, ""), (103, "\n\n"), (None, "User q logged in from host z9 at noon\nmore text stays here")]
    rows += [rows[0], (104, "word " * 30)]
    got = {(r.doc_id, r.text, r.n_dropped) for r in linededup.without_recurring_lines(docs(rows)).collect()}
    kept = {k: t for k, t, n in got if n}
    assert set(kept) == {*range(12), None}
    assert kept[3] == "down ewords here fly" and kept[None] == "more text stays here"
    assert {(100, "User a logged in from host b at noon", 0), (101, None, 0), (102, "", 0), (103, "\n\n", 0), (104, "word " * 30, 0)} <= got
    out = linededup.without_recurring_lines(docs(odd_rows)).collect()
    assert len(out) == len(odd_rows) and not any(r.n_dropped for r in out)
    assert linededup.without_recurring_lines(docs([])).count() == 0
    plan = linededup.without_recurring_lines(docs(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_frequent_values_are_fields_too(spark, docs):
    names = [chr(97 + k) + "ob" for k in range(20)]
    rows = [(20 * i + j, f"Login accepted for user {a} from host {b}x\n{a}{b}") for i, a in enumerate(names) for j, b in enumerate(names)]
    got = linededup.without_recurring_lines(docs(rows)).collect()
    assert len(got) == 400 and all(r.n_dropped == 1 and " " not in r.text for r in got)


@pytest.mark.parametrize("n", [99, 110, 1_000])
def test_fields_do_not_depend_on_the_number_of_documents(spark, docs, n):
    names = [f"{c}ob" for c in "bcdfghjkl"]
    rows = [(k, f"Login accepted for user {names[k % 9]} host {names[k // 9 % 9]} port {names[k // 81 % 9]}\nown{'x' * k} words{'y' * k}") for k in range(n)]
    assert all(r.n_dropped == 1 for r in linededup.without_recurring_lines(docs(rows)).collect())


def test_long_lines_recur_by_their_wording(spark, docs):
    notice = "please note that " * 8 + "until 2024"
    rows = [(k, f"{notice.replace('2024', str(2000 + k))}\n{'x' * k} own{'y' * k}") for k in range(50)] + [(90, notice + " and more\nown z text")]
    assert {(r.doc_id, r.n_dropped) for r in linededup.without_recurring_lines(docs(rows)).collect()} == {*((k, 1) for k in range(50)), (90, 0)}


def test_long_lines_have_templates(spark, docs):
    def line(k, n):
        return " ".join(["dear", "reader", "of", f"{chr(97 + k % 26)}ob", *(f"{'xyz'[k % 3] * (k + 1)}" if j % 3 == 0 else f"word{chr(97 + j % 26)}" for j in range(n))])

    # As many tokens and the same leading words, but no token that most have.
    other = [(k, " ".join(["one", "of", "these", *(f"{chr(97 + k)}{chr(97 + j % 26)}" for j in range(40))])) for k in range(200, 220)]
    rows = [(k, f"{line(k, 40)}\n{line(k, 3000)}\nown{'x' * k} words{'y' * k}") for k in range(50)] + [(90, f"{line(0, 41)}\nown z text"), *other]
    got = {(r.doc_id, r.n_dropped, r.text) for r in linededup.without_recurring_lines(docs(rows)).collect()}
    assert got == {*((k, 2, f"own{'x' * k} words{'y' * k}") for k in range(50)), *((k, 0, t) for k, t in rows[50:])}


@pytest.mark.parametrize("voters, places, sent", [(3, 7, 0), (1000, 5, 10**6), (64, 1024, 10**6)])
def test_templates_do_not_depend_on_how_documents_vote(spark, docs, monkeypatch, voters, places, sent):
    """Against counts of every leaf: tokens that all, 30, 21, 20 or one of 40 documents have."""
    monkeypatch.setattr(linededup, "VOTERS", voters)
    monkeypatch.setattr(linededup, "PLACES", places)
    monkeypatch.setattr(linededup, "SENT", sent)
    has = {"a": lambda k: True, "b": lambda k: k % 4, "c": lambda k: k < 21, "d": lambda k: k % 2, "e": lambda k: False}
    rows, want = [], {}
    for leaf, kinds in enumerate(["a" * 10 + "d" * 6 + "e" * 16, "a" * 12 + "c" * 5 + "d" * 9 + "e" * 8, "b" * 17 + "e" * 18, "c" * 20 + "d" * 19, "a" * 9 + "bc" * 5 + "de" * 8, "d" * 40, "e" * 41]):
        lines = [["lead" + chr(97 + leaf), "and", "on", *("word" + chr(97 + j % 26) if has[kind](k) else f"{chr(97 + k % 26)}{chr(97 + k // 26)}q" for j, kind in enumerate(kinds + "e")), "7" if k % 3 else "v"] for k in range(40)]
        rows += [(100 * leaf + k, " ".join(tokens)) for k, tokens in enumerate(lines)]
        masked = [["<*>" if t == "7" else t for t in tokens] for tokens in lines]
        fixed = [next((t for t in column if t != "<*>" and column.count(t) > 20), None) for column in zip(*masked, strict=True)]
        shown = [[t if t == f else "<*>" for t, f in zip(tokens, fixed, strict=True)] for tokens in masked]
        want |= {100 * leaf + k: " ".join(t) for k, t in enumerate(shown) if shown.count(t) >= 10 and 2 * t.count("<*>") <= len(t)}
    got = {r.doc: r.template for r in linededup.recurring_lines(docs(rows)).collect()}
    assert got == want and {k // 100 for k in want} == {1, 2, 3, 4}


def test_documents_of_recurring_lines_keep_the_first_of_each(spark, docs):
    two = "the first line of all\n\nand a second one"
    log = "a line of a log\n" * 3_000 + "its usual end"
    rows = [(k, two) for k in range(50, 0, -1)] + [(100 + k, log) for k in range(11)] + [(200, "the first line of all\nbut also other words")] + [(None, two)] * 2
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in linededup.without_recurring_lines(docs(rows)).collect()}
    assert got.pop(1) == (2, 0, two) and got.pop(200) == (2, 1, "but also other words")
    assert got.pop(100) == (3_001, 2_999, "a line of a log\nits usual end")
    assert all(v == ((2, 2, "") if k is None or k < 100 else (3_001, 3_001, "")) for k, v in got.items()) and len(got) == 60
    whole = linededup.without_recurring_lines(docs(rows), keep_copies=True)
    assert [(r.doc_id, r.n_dropped) for r in whole.where("n_dropped > 0").collect()] == [(200, 1)]


def test_very_many_dropped_lines(spark, docs):
    rows = [(k, "\n".join(f"line {'abc'[j % 3]} {j % 977}" for j in range(60_000)) + f"\nown {'x' * k} end") for k in range(10)]
    got = linededup.without_recurring_lines(docs(rows)).collect()
    assert {(r.n_lines, r.n_dropped) for r in got} == {(60_001, 60_000)} and {r.text for r in got} == {f"own {'x' * k} end" for k in range(10)}
