from reelgauge.llm import licences as L

MIT = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction, including without limitation the rights
# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
# copies of the Software, and to permit persons to whom the Software is
# furnished to do so, subject to the following conditions:
#
# The above copyright notice and this permission notice shall be included in all
# copies or substantial portions of the Software.
"""


def ids(text):
    return [x for _, x in L.sentence_ids(text)]


def found(text):
    return L.licences_of(L.sentence_ids(text))


def test_every_rule_matches_its_own_sentences():
    for licence, rule in L.RULES:
        text = ". ".join(L.SENTENCES[x].replace("*", "some one") for x in rule) + "."
        assert ids(text) == rule or "gpl" in rule[0]
        assert licence in found(text) or "gpl-free" in rule


def test_wrapped_commented_and_mixed_case():
    assert ids(MIT) == ["mit-grant", "mit-notice"] and found(MIT) == ["MIT"]
    assert found("Some text without an end\nLicensed under the Apache License, Version 2.0.") == ["Apache-2.0"]
    assert found("RELEASED UNDER THE MIT LICENSE.") == ["MIT"]
    assert found("Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.") == ["CC-BY-NC-4.0", "GPL-3.0"]
    assert ids("Neither the name of the Foo Bar, Inc nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.") == ["bsd-names"]


def test_order_and_gap():
    grant, notice = L.SENTENCES["mit-grant"], L.SENTENCES["mit-notice"]
    assert found(f"{notice}. {grant}.") == []
    assert found(f"{grant}. x. y. {notice}.") == ["MIT"]
    assert found(grant + ". unknown words here" * 40 + f". {notice}.") == []


def test_prose_about_licences_is_none():
    for text in ("The licence of the driver was lost.", "He had permission to use the software.", "Not licensed under the sea", "all rights reserved"):
        assert found(text) == []


def test_prefilter_drops_nothing(spark, sf_dir, odd, none):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    rows = L.scan(documents).join(documents.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == documents.count() and any(x.licences for x in rows)
    for x in rows:
        assert set(x.licences) == {name for line, name in lines.items() if line in x.text}
    assert L.scan(odd).filter("size(licences) = 0").count() == odd.count() and L.scan(none).count() == 0


def test_lead_ins_tails_and_common_notices():
    for text, want in {
        "This project is licensed under the MIT License.": ["MIT"],
        "Distributed under the MIT License.": ["MIT"],
        "Licensed under the MIT License, see LICENSE.": ["MIT"],
        "Licensed under the Apache License 2.0": ["Apache-2.0"],
        "Code: made available under the terms of the Apache-2.0 license; see NOTICE": ["Apache-2.0"],
        "// SPDX-License-Identifier: MIT": ["MIT"],
        "SPDX-License-Identifier: (MIT OR Apache-2.0)": ["MIT", "Apache-2.0"],
        "# SPDX-License-Identifier: GPL-2.0-or-later\nint x;": ["GPL-2.0-or-later"],
        "/* SPDX-License-Identifier: LGPL-2.1-only */": ["LGPL-2.1"],
        "dual licensed under MIT or Apache 2.0 at your choice": ["MIT", "Apache-2.0"],
        "It is released under the GNU GPLv3, or any later version.": ["GPL-3.0-or-later"],
        "You find it licensed under the GNU General Public License, version 3, here.": ["GPL-3.0"],
        "All text is available under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA-4.0"],
        "the following. " + L.SENTENCES["mit-grant"] + " and so on " + L.SENTENCES["mit-notice"] + " ok": ["MIT"],
        "The MIT License (MIT)\n\nCopyright (c) someone": ["MIT"],
    }.items():
        assert found(text) == want, text
    for text in ("He read the MIT License twice.", "available under the counter", "released under the bridge", "under permission of the owner"):
        assert found(text) == []


def test_a_star_takes_as_little_as_it_can():
    one = L.SENTENCES["bsd-names"].replace("*", "the owner")
    assert ids(f"{one}. {L.SENTENCES['mit-line']}. {one}.") == ["bsd-names", "mit-line", "bsd-names"]
