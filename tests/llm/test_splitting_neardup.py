import itertools
import random

import numpy as np
import pytest

from inkmill.llm import neardup, splitting

RNG = random.Random(5)
WORDS = [f"w{i}" for i in range(400)]


def prose(n, words=WORDS):
    return "".join(RNG.choice(words) + (". " if RNG.random() < 0.1 else "\n\n" if RNG.random() < 0.03 else " ") for _ in range(n))


def test_pieces_cover_the_text_within_the_limit_and_share_the_overlap():
    for text, limit, overlap in [(prose(900), 700, 120), ("x" * 5000, 300, 50), ("a\n" * 1000, 97, 40), (prose(50), 10_000, 5), ("가나다. " * 500, 128, 0), ("|a|b|\n" * 300, 200, 20), (prose(60), 9, 8), ("word " + "y" * 300, 100, 10)]:
        cut = splitting.cut(text, limit, limit, overlap)
        assert cut[0][:2] == (0, 0) and cut[-1][2] == len(text)
        for (_, _, e), (b, o, _) in itertools.pairwise(cut):
            assert o == e and o - b == min(overlap, o)
        assert all(e - b <= max(2, limit) and e > o for b, o, e in cut)


def test_a_bare_cut_is_the_last_resort_and_an_overlap_without_room_an_error():
    assert splitting.cut("word " + "y" * 300, 100, 100, 10)[0][2] == 5
    with pytest.raises(ValueError):
        splitting.cut("word " * 9, 10, 10, 10)


def test_the_pieces_of_whole_records_join_back_to_their_text(spark):
    texts = {k: prose(200 + 90 * k) for k in range(8)}
    df = spark.createDataFrame([(k, t, 60) for k, t in texts.items()], "rec_id bigint, markdown string, pages int")
    profiles = spark.createDataFrame([("a", 600, None, 50), ("b", 900, 20, 120), ("c", None, 9, 30)], "profile string, max_chars int, max_pages int, overlap_chars int")
    rows = splitting.pieces(df, profiles).orderBy("profile", "rec_id", "piece_no").collect()
    for (profile, rec_id), own in itertools.groupby(rows, key=lambda r: (r["profile"], r["rec_id"])):
        own = list(own)
        assert "".join(r["piece"][r["own_char"] - r["begin_char"] :] for r in own) == texts[rec_id]
        assert all(len(r["piece"]) <= {"a": 600, "b": 900}.get(profile, 10**9) for r in own)
        asked = {"a": 50, "b": 120, "c": 30}[profile]
        assert all(r["own_char"] - r["begin_char"] == min(asked, r["own_char"]) and x["piece"].endswith(r["piece"][: r["own_char"] - r["begin_char"]][-len(x["piece"]) :]) for x, r in itertools.pairwise(own))


def test_cuts_lie_where_the_topic_changes():
    topics = [" ".join(RNG.choice([f"t{k}x{j}" for j in range(12)]) for _ in range(30)) for k in range(2) for _ in range(6)]
    text = "\n\n".join(topics)
    change = len("\n\n".join(topics[:6])) + 2
    assert splitting.cut(text, int(change * 1.3), 10**9, 0)[0][2] == change


def test_line_and_sentence_ends_are_cut_where_the_topic_changes_too():
    rng = random.Random(9)
    topics = [" ".join(rng.choice([f"t{k}x{j}" for j in range(12)]) for _ in range(30)) for k in range(2) for _ in range(6)]
    for mark in ("\n", ". ", " |\n| "):
        text = "| " * ("|" in mark) + mark.join(topics)
        change = text.index("t1x") - 2 * ("|" in mark)
        assert splitting.cut(text, int(change * 1.3), 10**9, 0)[0][2] == change, mark


def test_which_records_are_cut(spark):
    rows = [(1, "x" * 11, 1), (1, "x" * 11, 1), (2, "x" * 10, 1), (3, "y y", 9), (4, None, 99), (5, "", 99), (6, "z" * 4, None), (7, "가 " * 40, 3)]
    df = spark.createDataFrame([(*r, "p") for r in rows], "rec_id bigint, markdown string, pages int, profile string")
    profiles = spark.createDataFrame([("c", 10, None, 3), ("c", 10, None, 3), ("p", None, 5, 1), ("n", None, None, 1), ("b", 50, 2, None)], "profile string, max_chars int, max_pages int, overlap_chars int")
    got = {(r["profile"], r["rec_id"]) for r in splitting.pieces(df, profiles).where("piece_no = 1").collect()}
    assert got == {("c", 1), ("p", 3), ("c", 7), ("b", 7), ("b", 3)}
    assert splitting.pieces(df.limit(0), profiles).count() == 0 and splitting.pieces(df, profiles.limit(0)).count() == 0


def shingle_set(text, k):
    words = [w for w in text.lower().replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    return set(zip(*(words[i:] for i in range(k)), strict=False))


def test_pairs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)  # so that bands are dealt to several blocks
    texts = {}
    for base in range(6):
        words = prose(120).split(" ")
        for v in range(12):
            own = words[:]
            for _ in range(v):
                own[RNG.randrange(len(own))] = f"e{RNG.random()}"
            texts[len(texts)] = " ".join(own)
    texts |= {100: texts[3].upper().replace(" ", "\t \r\n"), 101: "one two", 102: "one two three", 103: "one two three", 104: "", 105: None}
    rows = [(i, t) for i, t in texts.items()] + [(3, texts[3])]
    got = {tuple(r) for r in neardup.near_pairs(spark.createDataFrame(rows, "rec_id bigint, markdown string")).collect()}
    sets = {i: shingle_set(t, 3) for i, t in texts.items() if t}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    assert got == want and (102, 103) in got and len(want) > 40


def test_groups_join_chains_and_copies(spark):
    chain, words = [], [f"c{i}" for i in range(60)]
    for step in range(9):
        chain.append(" ".join(words[step * 3 : step * 3 + 30]))
    rows = [(10 + i, t) for i, t in enumerate(chain)] + [(5, chain[4]), (90, "a b c d"), (91, None)]
    got = {r["rec_id"]: r for r in neardup.groups(spark.createDataFrame(rows, "rec_id bigint, markdown string"), threshold=0.7).collect()}
    assert {got[i]["group_id"] for i in got if i != 90} == {5} and got[90]["group_id"] == 90 and got[90]["links"] == 0
    assert got[14]["class_id"] == got[5]["class_id"] == 5 and got[10]["links"] >= 1 and 91 not in got


def test_the_sketch_estimates_differences():
    a, b = neardup._parameters()
    x = np.arange(1, 400, dtype=np.uint64)
    for drop in (0, 40, 200):
        one, two = (neardup.odd_sketch(neardup.samples(neardup._mix(s), a, b)) for s in (x, x[drop:]))
        bits = np.unpackbits((one ^ two).view(np.uint8)).sum()
        assert (bits <= neardup.differing(0.7)) == (drop < 200)
