"""Small documents with every edge case the operators define."""

from __future__ import annotations

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, size string, kept int"


def rows():
    base = "the quick brown fox jumps over the lazy dog while many other animals look on from the far side of the old field"
    long = " ".join(f"word{k % 977} and" for k in range(12000))
    texts = [
        base, base, base + " again", None, "", " \t\n ", "one", "two words", long, long + " end",
        "write to a.b-c@mail.example.com, x@y or @z.com; 10.0.0.256 and 192.168.1.10 and 1.2.3.4.5.6.7.8; 10.0.0.1, 010.000.00.255, 0.0.0.0, 1.2.3.256",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112, 12345; call +1 (743) 555-3824 or +12 or +1234567890123456",
        'api_key = "66a6345cee33dd66a6345cee" ssn 123-45-6789 phone (212) 555-0100',
        "CC BY 4.0. cc by cc by; GNU General Public License version 3. All rights reserved", "Licensed under the MIT License. SPDX-License-Identifier: Apache-2.0",
        "中文 \U0001f642\U0001f642 éè don't we'll 'š x''s", "a@b.c_d@e.f " * 30, "0" * 5000 + " " + "1 " * 3000,
    ]
    out = [(k, t, ["en", None, "fr"][k % 3], ["s1", "s2", None][k % 3] if k else "s1", 1, "x", "y", k) for k, t in enumerate(texts)]
    return [*out, out[0], (None, base, "en", "s1", 1, "x", "y", 1), (None, None, None, None, None, None, None, None), (-5, "negative id text", "en", "s3", 1, None, None, 0)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
