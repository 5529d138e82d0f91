import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tripflow.llm import licences as s

MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software. The above copyright notice and this permission notice
shall be included in all copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND."""
CASES = [(None, "", 0), ("", "", 0), ("An essay on permission and warranty.", "", 0), (MIT, "MIT", 0),
         ("Released under the MIT License.\nText.\nLicensed under the Apache License, Version 2.0.", "MIT,Apache-2.0", 0),
         ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 0), ("all  rights -- RESERVED", "all-rights-reserved", 0),
         ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted.", "", 1),
         ("word " * 50_000 + "\nReleased under the MIT License. " + "word " * 50_000, "MIT", 0),
         ("Released under the MIT License. Released under the MIT License.", "MIT", 0)]


def test_rules(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(CASES)], "doc_id long, text string") \
        .withColumn("licences", F.lit("clash"))
    got = {r.doc_id: r for r in s.scan(docs).collect()}
    for k, (_, names, left) in enumerate(CASES):
        assert (got[k].licences, got[k].n_unmatched) == (names, left), CASES[k][0]
    assert got[3].sentence_ids == "<mit-permission><mit-notice><asis-warranty>"
    assert s.scan(docs.limit(0)).count() == 0


HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "MIT": "The MIT License (MIT)\n\nCopyright (c) 2020 A B\n\n" + MIT,
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS".""",
    "BSD-3-Clause": "// SPDX-License-Identifier: BSD-3-Clause\nint main() {}",
    "GPL-2.0-only": "/* SPDX-License-Identifier:GPL-2.0-only */ code",
}
UNNAMED = ["SPDX-License-Identifier: MIT OR ISC\n", "SPDX-License-Identifier:\nMIT", "the mit license plate"]
# two known sentences in one cut, the later of the list first
TURNED = "Provided by the copyright holders? This software is provided by the copyright holders and contributors as is and " \
         "redistributions in binary form must reproduce the above copyright notice"


def test_headers_are_known_in_text_order(spark):
    docs = spark.createDataFrame([*HEADERS.items(), *((f"{k}", t) for k, t in enumerate(UNNAMED)), ("turned", TURNED)],
                                 "doc_id string, text string")
    got = {r.doc_id: r for r in s.scan(docs).collect()}
    for name in HEADERS:
        assert (got[name].licences, got[name].n_unmatched) == (name, 0), got[name]
    assert got["Apache-2.0"].sentence_ids == "<apache-grant><apache-copy><apache-asis>"
    assert got["MIT"].sentence_ids == "<mit-title><mit-permission><mit-notice><asis-warranty>"
    assert all(got[f"{k}"].licences == "" for k in range(len(UNNAMED)))
    assert got["turned"].sentence_ids == "<bsd-warranty><bsd-binary>"


def test_sql_on_the_same_texts(spark):
    texts = [t for t, _, _ in CASES] + list(HEADERS.values()) + UNNAMED + [TURNED]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, s.scan(docs).collect())) == sorted(con.execute(s.ORACLE_SQL).fetchall())


def test_earlier_rules_take_longer_sequences_first(spark):
    text = ("Redistribution and use in source and binary forms, with or without modification, are permitted. "
            "Redistributions of source code must retain the above copyright notice. "
            "Redistributions in binary form must reproduce the above copyright notice. "
            "Neither the name of X nor Y may be used to endorse or promote products. All rights reserved.")
    row = s.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licences == "BSD-3-Clause,all-rights-reserved"
