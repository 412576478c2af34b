"""Licence sentences and rules."""

import cases
import compare
import pytest

from newspipe.llm import licences
from newspipe.llm.queries import ORACLE, REGISTRY

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
    "of this software and associated documentation files (the \"Software\"), to deal\n"
    "in the Software without restriction, including without limitation the rights\n"
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
    "copies of the Software, and to permit persons to whom the Software is\n"
    "furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all\n"
    "copies or substantial portions of the Software.\n"
)


@pytest.mark.parametrize(
    "text, ids, found, left",
    [
        ("Some text.\nReleased under the MIT License.\nMore", "mit-released", "MIT", ""),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc", "CC-BY-NC-4.0", ""),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl3-work", "GPL-3.0-only", ""),
        ("x. Licensed under the Apache License, Version 2.0. y", "apache2-licensed", "Apache-2.0", ""),
        ("/* " + MIT.replace("\n", "\n * ") + "*/", "mit-grant,mit-notice", "MIT", ""),
        (
            "Licensed under the Apache License, Version 2.0 (the \"License\");\n"
            "you may not use this file except in compliance with the License.",
            "apache2-licensed,apache2-may-not-use", "Apache-2.0", "",
        ),
        ("Released under the MIT License. Licensed under CC BY 4.0.", "mit-released,cc-by", "MIT,CC-BY-4.0", ""),
        ("All rights reserved.", "all-rights", "", "all-rights"),
        ("you may not use this file except in compliance with the License", "apache2-may-not-use", "", "apache2-may-not-use"),
        ("A license to write: nothing known here.", "", "", ""),
        ("This program is free software.", "free-software", "", "free-software"),
        ("// SPDX-License-Identifier: MIT\nint x;", "spdx-MIT", "MIT", ""),
        ("# SPDX-License-Identifier: LGPL-2.1-or-later", "spdx-LGPL-2.1-or-later", "LGPL-2.1-or-later", ""),
        (
            "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
            "cc-by-sa", "CC-BY-SA-4.0", "",
        ),
        (
            "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser"
            " General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or"
            " (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut"
            " WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR"
            " PURPOSE.  See the GNU\nLesser General Public License for more details.\n\nYou should have received a copy of"
            " the GNU Lesser General Public\nLicense along with this library.",
            "free-software,lgpl-terms,either-21-or-later,gpl-no-warranty,gnu-implied,lgpl-see,lgpl-received",
            "LGPL-2.1-or-later", "",
        ),
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
            " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
            " (at your option) any later version.",
            "free-software,agpl3-or-later", "AGPL-3.0-or-later", "",
        ),
    ],
)
def test_texts(spark, text, ids, found, left):
    row = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.sentence_ids, row.licences, row.unmatched) == (ids, found, left)
    assert row.n_known == len([i for i in ids.split(",") if i])


BSD = [
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the"
    " following conditions are met:\n",
    "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the"
    " following disclaimer.\n",
    "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the"
    " following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n",
    "3. Neither the name of the University nor the names of its\n   contributors may be used to endorse or promote"
    " products derived from\n   this software without specific prior written permission.\n",
    "3. All advertising materials mentioning features or use of this software\n   must display the following"
    " acknowledgement:\n   This product includes software developed by the organization.\n",
]


@pytest.mark.parametrize(
    "parts, found",
    [([0, 1, 2], "BSD-2-Clause"), ([0, 1, 2, 3], "BSD-3-Clause"), ([0, 1, 2, 4, 3], "BSD-4-Clause"), ([0, 1], "BSD-1-Clause")],
)
def test_clauses_tell_licences_apart(spark, parts, found):
    text = "Copyright (c) 2020 Someone\n\n" + "".join(BSD[i] for i in parts)
    row = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.licences, row.unmatched.replace("?", "").strip(",")) == (found, "")


def test_unknown_sentences_stop_a_rule(spark):
    """A clause that nobody knows makes it another licence."""
    text = BSD[0] + "0. You may not endorse anything on Mondays.\n" + BSD[1]
    row = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.licences, row.unmatched, row.n_known) == ("", "bsd-permitted,?,bsd-source", 2)


def test_no_known_sentence_is_passed_over():
    import re

    for texts in licences.SENTENCES.values():
        for text in texts:
            for spelled in (text, text.upper().replace(" ", "-\n")):
                assert re.search(licences.HINT, spelled), text


def test_order_matters(spark):
    """Sentences of a rule that stand apart do not make its licence."""
    text = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\nAll rights reserved.\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    row = licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licences == "" and row.unmatched == "bsd-source,all-rights,bsd-permitted"


@pytest.mark.parametrize("rows", [cases.ROWS, []])
def test_awkward_rows(spark, tmp_path, rows):
    more = [(20, None), (21, "Released under the MIT License.\n" * 3), (22, "license " * 50_000)] if rows else []
    df = cases.documents(spark, [*rows, *more])
    got = compare.spark_rows(licences.scan_licences(df))
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == compare.sql_rows(duck, licences.oracle_sql("documents"))


def test_query_matches_sql(spark, sf_dir):
    got = compare.spark_rows(REGISTRY["op3_sentence_rules"](spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), ORACLE["op3_sentence_rules"])
    plan = REGISTRY["op3_sentence_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_tables_are_consistent():
    texts = [t for ts in licences.SENTENCES.values() for t in ts]
    assert len(texts) == len(set(texts)) < 200
    assert {i for _, ids in licences.RULES for i in ids} <= set(licences.SENTENCES)
