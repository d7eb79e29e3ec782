from __future__ import annotations

from eventloom.llm import licenses

BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
GPL = "you can redistribute it and/or modify\nit under the terms of the GNU\n General Public\n License"


def test_wrapped_wordings(spark):
    """Line ends inside a wording hide it nowhere in a text."""
    rows, want = [], {}
    for k in range(40):
        before, after = "filler " * k, " filler" * 50
        for label, wording in (("bsd", BSD), ("gpl", GPL), ("bsd", BSD.replace(" ", "\n"))):
            want[len(rows)] = label
            rows.append((len(rows), f"{before}\n{wording}{after}"))
    for text in (BSD.split("\n")[0], "all" + " filler" * 60 + "\nrights reserved", None, ""):
        want[len(rows)] = ""
        rows.append((len(rows), text))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in found} == want
    assert all((r.score == 1.0) == bool(r.labels) for r in found)


def test_words_that_are_merely_near(spark):
    """The German word mit near another license, and wordings in another order, state nothing."""
    filler = "der hund lief mit seinem ball durch den garten und"
    rows = [
        (1, f"{filler} licensed under the apache license version 2 0 {filler} das wetter war gut", "apache"),
        (2, f"released {filler} under the apache license {filler}", "apache"),
        (3, f"mit {filler} you can redistribute it under the terms of the gnu general public license {filler}", "gpl"),
        (4, "license mit the under released", ""),
        (5, "Released under\nthe MIT License.", "mit"),
        (6, "released under the old mit license", "mit"),
        (7, "permitted are modification without or with forms binary and source in use and redistribution", ""),
        (8, "rights all reserved all the rights are reserved", ""),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert {r.doc_id: r.labels for r in found} == {r[0]: r[2] for r in rows}


def test_whole_license_texts_as_templates(spark):
    """Templates may be long; a text that has most of one, with line ends and changes, is labelled."""
    wording = " ".join(f"word{k % 37} the clause{k}" for k in range(120))
    changed = wording.replace("clause7 ", "").replace("clause50", "other").replace(" ", "\n")
    rows = [(1, "start " + changed + " end"), (2, wording[: len(wording) // 2]), (3, " ".join(reversed(wording.split())))]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), [(wording, "own"), ("", "none")])
    assert {r.doc_id: r.labels for r in found.collect()} == {1: "own", 2: "", 3: ""}
