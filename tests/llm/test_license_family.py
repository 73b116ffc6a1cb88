"""Relatives among the licence templates."""

import pytest

from reportloom.llm import licenses

HEADER = (
    "This {} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {} Public License as "
    "published by\nthe Free Software Foundation{} either version {} of the License, or\n(at your option) any later version."
)


def test_relatives_get_their_own_name(spark, frame):
    texts = {
        "gpl-2.0-header": HEADER.format("program", ";", "General", ";", "2"),
        "gpl-3.0-header": HEADER.format("program", ":", "General", ",", "3"),
        "agpl-3.0-header": HEADER.format("program", ":", "Affero General", ",", "3"),
        "lgpl-2.1-header": HEADER.format("library", ";", "Lesser General", ";", "2.1"),
        "lgpl-3.0-header": HEADER.format("library", ";", "Lesser General", ";", "3"),
    } | {k: licenses.TEMPLATES[k] for k in ("bsd-2-clause-text", "bsd-3-clause-text", "zlib", "epl-2.0")}
    # Texts by their first and last words alone would be no match.
    texts |= {k: "Copyright 2020 Someone Else\n\n" + text for k, text in licenses.TEXTS.items()}
    docs = frame([(i, text, k, None) for i, (k, text) in enumerate(texts.items())])
    found = {r["doc"]: r for r in licenses.license_scan(docs, licenses.template_frame(spark)).collect()}
    for i, name in enumerate(texts):
        assert found[i]["best_license"] == name, name


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_no_template_is_named_twice(name):
    plain = {k: " ".join(t.lower().split()) for k, t in licenses.TEMPLATES.items()}
    assert [k for k, t in plain.items() if t == plain[name]] == [name]
