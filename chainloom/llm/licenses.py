"""Licence scans: digests of canonical texts, joined with the digests of known licences.

Columns and SQL functions only. A whole text is canonicalised (letter case, punctuation, copyright notices and
spellings that count as equal) and hashed; equal digests are the same licence. The same is done for every line
that names a licence, which finds the short notices on top of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.llm.shared import fitting

BROADCAST_LICENSES = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(?m)^[\x20\t#*/;%-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
# A line that is a copyright notice: the word with (c), a year or a place for one, or with nothing but a holder up to
# the line's end; (c) with a year or a holder after "by"; the reservation alone. Lines of running text that happen to
# start with such a word stay, so that a digest does not depend on where lines are broken. The SQL keeps
# COPYRIGHT_LINE; the two differ only on such lines.
YEAR = r"[\[<{(]?(?:(?:19|20)[0-9]{2}|years?|y{2,4})\b"
SIGN = r"(?:\(c\)|©|&copy;)"
NOT_HOLDERS = (
    "and act acts as assignment at by claim claims clause for from grant holder holders if in infringement interest interests is "
    "law laws licence licences license licenses line lines message messages notice notices of on or over owner owners ownership "
    "page permission permissions protection right rights statement statements that term terms the to treaty under which with"
)
NOTICE_LINE = (
    r"(?m)^[\x20\t#*/;%-]*(?:"
    rf"copyrights?\b[\x20\t:,]*(?:{SIGN}|{YEAR})[^\n]*"
    rf"|copyrights?\b[\x20\t:]+(?:by[\x20\t]+(?:the[\x20\t]+)?)?(?!(?:{'|'.join(NOT_HOLDERS.split())})\b)[^\s]+(?:[\x20\t]+[^\s]+){{0,4}}"
    r"(?:[\x20\t.,]+all[\x20\t]+rights[\x20\t]+reserved)?"
    rf"|{SIGN}[\x20\t]*(?:copyright\b[\x20\t:,]*)?{YEAR}[^\n]*"
    rf"|{SIGN}[\x20\t]*(?:copyright|by)\b[^\n]*"
    r"|©[^\n]*"
    r"|all[\x20\t]+rights[\x20\t]+reserved"
    r")[\x20\t\r.,;*/#-]*$"
)
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LICENSE_WORDS = r"licen[cs]|gpl|spdx"

# Spellings that licence matching takes as equal, as pattern and replacement on lower-case text.
EQUIVALENT = [
    ("https://", "http://"),
    ("©", "(c)"),
    ("[‘’]", "'"),
    ("[“”]", '"'),
    ("[–—]", "-"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("fulfill", "fulfil"),
    ("organisation", "organization"),
    ("authorisation", "authorization"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
]

# Published licence texts and the notices that stand for a licence.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = [
    ("MIT", MIT),
    ("MIT", "The MIT License (MIT)\n" + MIT),
    ("MIT", "MIT License\n" + MIT),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_NAMES + BSD_TAIL),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]


def canonical(text: Column) -> Column:
    """Lower case (A-Z), no copyright notices, one spelling, and words with one space between them."""
    out = F.regexp_replace(F.translate(text, UPPER, LOWER), NOTICE_LINE, "")
    for pattern, equal in EQUIVALENT:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(equal)) if pattern.startswith("[") else F.replace(out, F.lit(pattern), F.lit(equal))
    return F.trim(F.regexp_replace(out, MARKS, " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(digest, license) of known texts; of licences with equal digests the first by name."""
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    rows = texts.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, license, n_notices, notices) for every row of documents.

    digest: of the canonical text; license: the licence that the whole text is, else null. n_notices: lines that
    are a known notice; notices: their licences, sorted, distinct, comma-joined. Null texts have the digest of
    the empty text; repeated rows are each scanned; an empty table gives no rows; other columns are not read.
    known: (digest, license), a row for each digest; it is broadcast up to 100,000 rows and shuffled beyond.
    """
    known = fitting(known, BROADCAST_LICENSES)
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = F.filter(F.split(text, "\n"), lambda x: F.translate(x, UPPER, LOWER).rlike(LICENSE_WORDS))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(canonical(text), 256).alias("digest"), named.alias("_lines"))
    whole = rows.join(known, "digest", "left")
    row = F.struct("doc_id", "digest", "license")
    lines = whole.withColumn("_row", F.monotonically_increasing_id()).select("_row", row.alias("_of"), F.explode_outer("_lines").alias("_line"))
    marks = known.select(F.col("digest").alias("_digest"), F.col("license").alias("_notice"))
    met = lines.withColumn("_digest", F.sha2(canonical(F.col("_line")), 256)).join(marks, "_digest", "left")
    out = met.groupBy("_row").agg(F.first("_of").alias("_of"), F.count("_notice").alias("n_notices"), F.collect_set("_notice").alias("_notices"))
    return out.select("_of.*", "n_notices", F.concat_ws(",", F.array_sort("_notices")).alias("notices"))
