import random

from inkmill.llm import abuse, personal, scans


def test_forms_of_personal_values():
    def of(text):
        return {(k, f) for k, f, *_ in personal.mentions(text) if k != "name"}

    assert of("to a.b_c+d@mail.x-y.example, or e [at] f [dot] g (dot) example.") == {("email", "a.b_c+d@mail.x-y.example"), ("email", "e [at] f [dot] g (dot) example")}
    assert of("ssh drain@parser:/srv, @channel, @vault/x@2.8.1, 1.20.38.4, 192.0.2.10, 4000-12-608, 2024-182-77, 2020-08-14 00:28") == set()
    for phone in ("+49 30 23125 031", "+82 10 0000 4354", "+1-808-555-0106", "0044 20 7946 0735", "(415) 555-0177", "(020) 7946 0206", "030/23125422", "030 23125-318", "020 7946 0998", "01000003794", "808.555.0119", "02-0000-7493", "010.0000.9715"):
        assert of(f"Call {phone}, then (after 10:36).") == {("phone", phone)}, phone
    for number in ("640608-2494658", "870904 - 1462236", "957-33-0627", "ZZ0809471", "ZZ 0670763", "QQ 32 80 75 A", "QQ920835C"):
        assert of(f"ID no. {number}, checked") == {("id", number)}, number
    for place in ("Flat 27, 181 Lantern Square, Tarnsea", "4 Alder Quay Road, Tarnsea 67968", "Ahornplatz 70, 70237 Altmar", "Mühlbachstraße 6, 70463 Altmar", "가온시 새빛구 솔뫼로 199 28호", "한여울시 늘봄구 해솔대로 106"):
        assert of(f"stored at {place}; it is.") == {("address", place)}, place
    assert of("The Copper Street bibliography; item K40-65O, code ZN23-48l.") == set()


def test_words_of_persons_are_told_from_others(spark):
    rng = random.Random(2)
    given, family = ["Ann", "Bob", "Cid", "Dora"], ["Stone", "Reed", "Moss-Hill"]
    rows = []
    for i in range(300):
        g, f = rng.choice(given), rng.choice(family)
        rows.append(("t", str(i), rng.choice([f"From: {g} {f} <{g}@x.example>", f"Contact person: {f.upper()}, {g}", f"The grant was signed by {g} {f}."]) + " North Bridge met South River. Between March and July it grew."))
    rows += [("d", "a", "yesterday Dora Moss-Hill came; Reed, Cid too. Thanks, Ann"), ("d", "a", "yesterday Dora Moss-Hill came; Reed, Cid too. Thanks, Ann"), ("d", "b", None), ("d", "c", ""), ("d", "e", "서명자: 김가람 / 김가람 님께 / 이정표 " * 3)]
    texts = spark.createDataFrame(rows, "origin_table string, ref_id string, text string")
    found = personal.judged(personal.candidates(texts))
    got = {(r["ref_id"], r["found"]) for r in found.where("kind = 'name'").collect()}
    assert {x for x in got if x[0] in "abce"} == {("a", "Dora Moss-Hill"), ("a", "Reed, Cid"), ("e", "김가람")}
    assert not any("North" in f or "March" in f for _, f in got)
    new = {r["ref_id"]: r["text"] for r in personal.redact(texts, found).collect()}
    assert new["a"] == "yesterday [NAME] came; [NAME] too. Thanks, Ann" and new["c"] == "" and "b" not in new and len(new) == 303
    assert personal.judged(personal.candidates(texts.limit(0))).count() == 0


def test_names_inside_runs_of_capitalised_words(spark):
    people = [f"{g} {f}" for g in ("Ann", "Bob", "Cid", "Mary", "Dora") for f in ("Stone", "Reed", "Moss-Hill")]
    rows = [("t", f"{i}", f"From: {p} <x{i}@x.example>\nNorth Bridge Meeting Notes: South River Report") for i, p in enumerate(people * 6)]
    own = {
        "signature": ("so be it.\n\nAnn Stone\nRecords Manager, Unit Four", {"Ann Stone"}),
        "header": ("From: Bob Reed\nDate: Monday\nSubject: Bridge", {"Bob Reed"}),
        "quoted": ("> From: Cid Moss-Hill\n> Date: Monday\n\nCid Reed\nTo be told", {"Cid Moss-Hill", "Cid Reed"}),
        "list": ("Ann Reed\nBob Stone\nDora Moss-Hill\nNorth Bridge", {"Ann Reed", "Bob Stone", "Dora Moss-Hill"}),
        "wrapped": ("it was Dora\nReed who came", {"Dora\nReed"}),
        "run": ("Contact Stone, Bob or see Annual Report Cid Stone", {"Stone, Bob", "Cid Stone"}),
    }
    rows += [("d", k, text) for k, (text, _) in own.items()]
    rows += [("m", f"{i}", "From: Ann Mary Stone <y@x.example>") for i in range(9)]
    texts = spark.createDataFrame(rows, "origin_table string, ref_id string, text string")
    found = personal.judged(personal.candidates(texts))
    got = {k: set() for k in own}
    for r in found.where("kind = 'name' AND origin_table = 'd'").collect():
        got[r["ref_id"]].add(r["found"])
    assert got == {k: names for k, (_, names) in own.items()}
    new = {(r["origin_table"], r["ref_id"]): r["text"] for r in personal.redact(texts, found).collect()}
    assert new["d", "list"] == "[NAME]\n[NAME]\n[NAME]\nNorth Bridge"
    assert "Stone" not in new["m", "0"]


def labelled(n, seed):
    rng = random.Random(seed)
    plain = ["the {0} was moved to the {1} in march", "each {0} must carry a {1} label", "kill the child process before the {0} aborts", "the parasite in the {0} sample died"]
    bad = ["shut your mouth, {0} clown, or regret it", "you filthy {0} idiot, nobody wants you", "all {0} people are vermin and must go"]
    nouns = ["bridge", "ledger", "harbour", "forest", "meter", "signal"]
    texts, y = [], []
    for _ in range(n):
        a = rng.random() < 0.4
        lines = [rng.choice(plain).format(rng.choice(nouns), rng.choice(nouns)) for _ in range(rng.randint(3, 9))]
        if a:
            lines.insert(rng.randrange(len(lines)), rng.choice(bad).format(rng.choice(nouns)))
        texts.append(".\n".join(lines))
        y.append(int(a))
    return texts, y


def test_abuse_is_found_on_held_out_texts_despite_wrong_labels(spark):
    texts, y = labelled(200, 1)
    noisy = [1 - a if i % 20 == 0 else a for i, a in enumerate(y)]
    model = abuse.fit(texts, noisy)
    more, truth = labelled(200, 2)
    df = spark.createDataFrame([(i, "s", t, "x") for i, t in enumerate(more)] + [(900, None, None, "x"), (901, "s", "", "x"), (902, "s", " \n ", "x"), (903, "s", "YOU F1LTHY bridge idiot, n o b o d y wants you", "x")], "doc_id bigint, source string, text string, score string")
    got = {r["doc_id"]: r for r in abuse.score(df, model).collect()}
    right = sum(got[i]["abusive"] == bool(t) for i, t in enumerate(truth))
    assert right >= 190 and got[903]["abusive"] and not any(got[i]["abusive"] or got[i]["score"] for i in (900, 901, 902))
    rates = {r["source"]: r for r in abuse.rates(abuse.score(df, model)).collect()}
    assert rates["s"]["docs"] == 203 and rates[None]["abusive_docs"] == 0
    assert abuse.fit(texts, [0] * 200) is None and abuse.score(df, None).where("abusive").count() == 0


def test_labels_that_disagree(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(labelled(30, 3)[0])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, None, "a"), (99, 1, "a")], "doc_id bigint, abusive int, rater string")
    assert abuse.fit_from(docs, labels) is None


CLEAN = ["the harbour was closed by the water board in march.", "our committee lists the entries of the modern museum.", "each bridge must carry a supplier-list before the summer.", "a careful department describes the original inventory."]


def test_scans_are_repaired(spark):
    rng = random.Random(7)
    rows = [(i, "\n\n".join(rng.choice(CLEAN) for _ in range(12)), None, "x") for i in range(200)]
    noisy = "Some Trust   Annual report   12\n\nthe harb0ur was cl¬\nosed by the watcr board in rnarch 2O19. our com-\n\n- 13 -\n\nSome Trust   Annual report   13\n\nmittee lists the entries of the modern supplier-\nlist.\n\n```\nc0de 5hall stay-\nas\n```\n\n| c0l |\n|---|\n| 1O |"
    tags = "<doctag>\n<page_header><loc_1>Some Trust   Annual report   12</page_header>\n<text><loc_1><loc_2>the museurn was closed.</text>\n<code>rnarch</code>\n</doctag>"
    rows += [(500, noisy, None, "x"), (500, noisy, None, "x"), (501, None, tags, "x"), (502, None, None, "x"), (503, "", "", "x"), (504, "item K40-65O, Flat 5b, ZZ0809471 and a@b1.example", None, "x")]
    got = {r["rec_id"]: r for r in scans.repaired(spark.createDataFrame(rows, "rec_id bigint, markdown string, doctags string, noise string")).collect()}
    assert set(got) == {500, 501} and got[500]["noise"] == ["header", "hyphen", "misread", "pageno"] and got[501]["noise"] == ["misread"]
    assert got[500]["markdown"] == "the harbour was closed by the water board in march 2019. our committee lists the entries of the modern supplier-list.\n\n```\nc0de 5hall stay-\nas\n```\n\n| c0l |\n|---|\n| 1O |"
    assert "the museum was closed." in got[501]["doctags"] and "<code>rnarch</code>" in got[501]["doctags"] and "Annual report   12" in got[501]["doctags"]


def test_page_numbers_and_running_titles():
    assert all(map(scans.page_number, ("31 / 71", "— 28 —", "- 40 -", "p. 22", "Page 1 of 41", "23쪽", "viii", "12", "l2 / 42")))
    assert not any(map(scans.page_number, ("- item", "Page one", "civil", "12 boxes", "a", "2020-01-01")))
    parts = scans.markdown_parts("Title A\n\ntext one.\n\n<!-- image -->\n\nCaption words\n\nTITLE A\n\n<!-- page break -->\n\nCaption words two\n\n- 3 -\n\n- item\n\nshort\n\nX – Y report – draft")
    gone, kinds = scans.furniture(parts)
    assert {parts[i].text for i in gone} == {"Title A", "TITLE A", "- 3 -", "X – Y report – draft"} and kinds == {"header", "pageno"}


def test_readings_explain_every_sign():
    assert "closed" in dict(scans.readings("cl0secl")) and "were" in dict(scans.readings("vverc")) and not dict(scans.readings("x%y"))
    assert scans.fixed_number("201b년", "") == "2016년" and scans.fixed_number("5b", "Flat") is None and scans.fixed_number("K40-65O", "") is None


def test_an_empty_table(spark):
    assert scans.repaired(spark.createDataFrame([], "rec_id bigint, markdown string, doctags string")).count() == 0


def test_lone_words_of_a_disclosed_name_go_too():
    text = "Ann Vandermoor wrote. Ask Ann, not Annabel; vandermoor@x.example stays, Vandermoor's desk"
    spans = [{"start": 0, "end": 14, "kind": "name"}]
    assert [(text[a:b], k) for a, b, k in personal._hidden(text, spans)] == [("Ann Vandermoor", "name"), ("Ann", "name"), ("Vandermoor", "name")]
    assert personal._hidden("nothing here", []) == []


def test_a_name_above_a_role_line_is_found(spark):
    rows = [("thread", f"m{i}", f"Hello all.\n\nQuentin Ullmarsson\nRecords Manager, Kestrel Lab\nTel 030/23125422\n\nFrom: Penelo Zandvliet\nDate: today {i}") for i in range(30)]
    rows += [("docling", f"d{i}", "The Water Board met in Tarnsea Harbour and Records Manager Office is shut.") for i in range(60)]
    found = personal.judged(personal.candidates(spark.createDataFrame(rows, "origin_table string, ref_id string, text string")))
    got = {(r["ref_id"], r["found"]) for r in found.where("kind = 'name'").collect()}
    assert got == {(f"m{i}", n) for i in range(30) for n in ("Quentin Ullmarsson", "Penelo Zandvliet")}


def test_held_out_scores_give_the_threshold():
    import numpy as np

    assert abuse.threshold(np.array([3.0, 2.5, -1.0, -2.0]), np.array([1, 1, 0, 0])) == 0.75
    assert -2 < abuse.threshold(np.array([3.0, -1.9, 2.5, -2.0, -3.0]), np.array([1, 1, 1, 0, 0])) < -1.9  # a wrong label low down is no reason to lose others


def test_short_passages_count_and_long_documents_are_used_whole_or_not_at_all(spark, monkeypatch):
    assert abuse.passages("You fool\n!!\n12") == ["you fool"]
    monkeypatch.setattr(abuse, "MAX_FIT_CHARS", 60)
    docs = spark.createDataFrame([(k, "word " * n) for k, n in ((1, 2), (2, 4), (3, 40), (4, 2))], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in (1, 2, 3, 4)], "doc_id bigint, abusive int")
    seen = []
    monkeypatch.setattr(abuse, "fit", lambda texts, abusive: seen.append((texts, abusive)))
    abuse.fit_from(docs, labels)
    assert seen == [(["word " * 2, "word " * 4, "word " * 2], [1, 0, 0])]
