import pytest

from granero.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this"""


@pytest.mark.parametrize(
    "text, labels",
    [
        (MIT, {"mit-text"}),
        (BSD, {"bsd"}),
        (MPL, {"mpl-2.0"}),
        (f"some words before {MIT} and others after {BSD}", {"mit-text", "bsd"}),
        (" ".join(f"x{i}" for i in range(2_000)) + " " + MPL, {"mpl-2.0"}),
        ("Released under the MIT License", {"mit"}),
        ("the book was released " + "word " * 50 + "under a license " + "word " * 50 + "by the mit press", set()),
        ("Licensed under CC BY 4.0", set()),
        ("Licensed under CC BY-NC 4.0", {"cc-by-nc"}),
        ("This work is licensed under the GNU General Public License, version 2", set()),
        ("This work is licensed under the GNU General Public\n License, version 3", {"gpl-3.0"}),
        ("", set()),
    ],
)
def test_notices_wherever_lines_break(text, labels):
    index = licenses.Windows(licenses.TEMPLATES, licenses.TELLING, licenses.THRESHOLD)
    words = text.encode().translate(licenses.LINES).split()
    assert {name for name, _, _ in index.match(words)} == labels


def test_query_of_notices(spark):
    docs = spark.createDataFrame([(1, MIT), (2, None), (3, f"{BSD}\n{BSD}")], "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.labelled(licenses.notices(docs)).collect()}
    assert found[1].labels == "mit-text" and found[1].score == 1.0
    assert found[2].labels == "" and found[2].score == 0.0
    assert found[3].labels == "bsd"
    # The lines that the SQL of op4_license_scan reads hold too little of these.
    assert licenses.labelled(licenses.scan(docs)).where("score > 0").count() == 0
