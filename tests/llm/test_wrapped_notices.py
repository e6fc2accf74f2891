"""License notices wrapped over several lines."""

from __future__ import annotations

import re
import textwrap

import pytest

from wardflow.llm import licenses

PUBLISHED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in it",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy was not distributed with this file",
    "apache": "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0",
}
PROSE = "The house stands in a street of the old town, and rain falls on stone and in the river at night."


def plain(text, templates):
    """Labels and score: every line and every window of words against every template."""
    lines = [[w for w in re.split(licenses.GAPS, line.lower()) if w] for line in text.split("\n")]
    words = [w for line in lines for w in line]
    labels, score = set(), 0.0
    for label, notice in templates:
        wanted, width = set(notice.split()), -(-100 * len(notice.split()) // 80)
        blocks = lines + [words[k : k + width] for k in range(len(words))]
        share = max(len(wanted & set(b)) for b in blocks) / len(wanted)
        if share >= 0.8:
            labels.add(label)
            score = max(score, share)
    return ",".join(sorted(labels)), score


def commented(text, width, mark):
    return "\n".join(mark + line for part in text.split("\n") for line in textwrap.wrap(part, width) or [""])


@pytest.mark.parametrize("width", [40, 70])
def test_wrapped_notices_are_met(spark, width):
    notices = [notice for _, notice in licenses.TEMPLATES]
    texts = [commented(t, width, mark) for t in [*PUBLISHED.values(), *notices] for mark in ("", " * ")]
    texts += [f"{PROSE}\n{t}\n{PROSE}" for t in texts] + ["\n".join([PROSE] * 30), "\n".join(notices[1].split())]
    # Enough words of a notice, but far apart.
    texts.append("\n".join(f"{w}\n{PROSE}" for w in notices[1].split()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for k, text in enumerate(texts):
        labels, score = plain(text, licenses.TEMPLATES)
        assert set(got[k].labels.split(",")) == set(labels.split(",")) | set(got[k].base_labels.split(",")) - ({""} if labels else set())
        assert got[k].score == (1.0 if got[k].base_labels else score)
    for k, label in enumerate(PUBLISHED):
        assert label in got[2 * k].labels.split(",") and label in got[2 * k + 1].labels.split(",")
    assert got[len(texts) - 1].labels == got[len(texts) - 3].labels == "" and got[len(texts) - 2].labels == "mit"
