"""License scans by canonical digest: normalise entire texts, hash, join with known digests.

Only built-in functions: the canonical form is a chain of five regular expressions, the
digest SHA-256, the lookup an equi-join. Known texts pass through the same chain, so a
rule needs to be consistent, not good English. The form is built once a document, with
its lines kept apart; the entire text and each line are looked up from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.session import cut_lineage

# The rules of the canonical form, in the order of use. First, what states a
# copyright goes: the word or sign with a year, a sign or a place to fill in, up to the end of
# its sentence or line (full stops after single letters and inside words do not end it); a line
# of the word and names; the reservation of rights.
_REST = r"(?:[^\n.]*[ .]\p{L}\.|[^\n.]*\.[^\s.]){0,20}[^\n.]*\.?"
STATEMENTS = "|".join(
    (
        r"(?i:copyright)[ \t:,]*(?:\([cC]\)|©|[12][0-9]{3}|[<\[{])" + _REST,
        r"(?:©|\([cC]\)[ \t]*(?i:copyright)?[ \t:,]*[12][0-9]{3})" + _REST,
        r"(^|\n)[ \t*#/;-]*Copyright(?: by)?(?:,? (?:\p{Lu}[\p{L}\p{N}.'-]*|&|and|of|the)){1,8}[ \t\r]*(?m:$)",
        r"(?i:all rights reserved)\.?",
    )
)
AND = "&"
# Then marks go; words stand between two blanks on either side, so that each rule has blanks of its own.
MARKS = r"[^\p{L}\p{N}\n]+"
# Words written as two.
JOINED = r"( (?:sub|non|per))[ \n]+(licen|commercial|infring|cent )"
# Equal spellings become alike by leaving out what differs between the two groups of a rule.
SPELLINGS = (
    r"(i)[sz]((?:e[ds]?|ing|ations?) )",
    r"(o)u(r(?:s|ed|ing|ite|ites|able)? )",
    r"((?:lic|off|def)en)[cs](e|ing)",
    r"(l)l((?:ed|ing) )",
    r"((?:judg|acknowledg))e(ments? )",
    r"((?:catal|anal)og)ue(s? )",
    r"((?:cent|met|lit))(?:re|er)(s? )",
    r"( (?:whil|among))(?:st|e)( )",
    r"( copyright[ \n]+)(?:owner|holder)(s? )",
    r"( fu)l+(fi)l+",
    r"( (?:w|sk)i)l+(fu)l+",
    r"( http)s( )",
)

# Known licences, and notices that stand for one.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)
_MIT_CONDITION = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software."
)
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN_LICENSES = (
    ("MIT", f"MIT License\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_CONDITION}\n\n{_MIT_WARRANTY}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_CONDITION}\n\n{_MIT_WARRANTY}"),
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:\n\n{_MIT_CONDITION}\n\n{_MIT_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\n{_MIT_GRANT}.\n\n{_MIT_WARRANTY}"),
    (
        "ISC",
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        + _ISC_WARRANTY,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _ISC_WARRANTY,
    ),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_TERMS}\n{_BSD_WARRANTY}"),
    ("BSD-2-Clause", f"{_BSD_TERMS}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_TERMS}{_BSD_NAME}\n{_BSD_WARRANTY}"),
    ("BSD-3-Clause", f"{_BSD_TERMS}{_BSD_NAME}\n{_BSD_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)


# Digests of canonical forms of licences too long to state here (their files as
# distributed with many systems; the canonical form has no copyright statements, case or marks).
FULL_TEXTS = (
    ("Apache-2.0", "43b5697ec01da680c4c71fc0d2341545df46a6078924b79037ca7596dc37ec30"),
    ("Artistic-1.0-Perl", "5ab07f12a18ff353caa9f8dc578608e702f8c6b6640648bbd581751404e7e51a"),
    ("CC0-1.0", "b633a4ef659f40502b514b7deb2fda1acc2f7037efec9e54c1719ffa3309a2b4"),
    ("GFDL-1.2", "d5b132c8439a44bd8acefc175bd2d86b7072ae6184e1e3567c8bfb2188cbd82e"),
    ("GFDL-1.3", "9d24985593349a3b190916887c209b2e9990791ecf75c6ed01feb0f397cae3df"),
    ("GPL-1.0", "db647276568dfd491fb62627674056b9c07cbc31c1bc52f1ea04afd3f3d86025"),
    ("GPL-2.0", "8fe0e5f8dfa9f114ae4e35bb93dc839098481acbba7e37e0bfbb5824dc5146a9"),
    ("GPL-3.0", "9ec646f9ad9c4ab5a91029863b59e07fee3104cb30fc59582475c7731c16f83b"),
    ("LGPL-2.0", "8546ca3ba0b8bf1d8583c637c77037a5bff2702e6f234719069ef5c105a4277a"),
    ("LGPL-2.1", "b668397bb59ff34df2962e64382cfdd96973e744ffa00966757a2337fda77504"),
    ("LGPL-3.0", "b3535557a334da7d72f0f603f95df67c1550469316d43bd372b73b2864176bed"),
    ("MPL-1.1", "cc3461665a84f7d55229d1e5dae93e8c8a2aef67c8382106172995ab4220ba56"),
    ("MPL-2.0", "6ef99057fb645b8ead4cf7dba556bffd405a6c3043ce080e564be1e6b7e0df7a"),
)


def _marked(text: Column) -> Column:
    """The canonical form with a line break, between blanks, for each of the text's; null stays null."""
    out = F.lower(F.regexp_replace(text, STATEMENTS, "$1 "))
    out = F.regexp_replace(F.replace(out, F.lit(AND), F.lit(" and ")), MARKS, "  ")
    out = F.concat(F.lit("  "), F.replace(out, F.lit("\n"), F.lit("  \n  ")), F.lit("  "))
    out = F.regexp_replace(out, JOINED, "$1$2")
    kept = "".join(f"${i}" for i in range(1, 2 * len(SPELLINGS) + 1))
    out = F.regexp_replace(out, "|".join(SPELLINGS), kept)
    return F.regexp_replace(out, " +", " ")


def _entire(marked: Column) -> Column:
    return F.trim(F.replace(marked, F.lit("\n "), F.lit("")))


def canonical(text: Column) -> Column:
    """Lower case, without copyright statements, words only, equal spellings alike; null stays null."""
    return _entire(_marked(text))


def _sha(form: Column) -> Column:
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def digest(text: Column) -> Column:
    """SHA-256 of the canonical form; null for null and for a text without a word."""
    return _sha(canonical(text))


def known_digests(known: DataFrame) -> DataFrame:
    """(known_digest, license, size), one row per digest: the name that sorts first.

    ``known`` has license and text, and may have ``digest`` for rows whose text is null;
    ``size`` is the length of the canonical form, null where only the digest is known.
    """
    form = canonical(F.col("text"))
    given = F.col("digest") if "digest" in known.columns else F.lit(None).cast("string")
    rows = known.select(F.coalesce(_sha(form), given).alias("known_digest"), "license", F.length(form).alias("size"))
    rows = rows.where("known_digest IS NOT NULL")
    return rows.groupBy("known_digest").agg(F.min("license").alias("license"), F.max("size").alias("size"))


def default_licenses(spark: SparkSession) -> DataFrame:
    rows = [(name, text, None) for name, text in KNOWN_LICENSES] + [(name, None, known) for name, known in FULL_TEXTS]
    return spark.createDataFrame(rows, "license string, text string, digest string")


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, license, notices.

    ``license`` is set if the entire text is a known one, in its canonical form; ``notices``
    names, in order and separated by commas, the licences of which an entire line is a
    known text given in full (null: none). Null texts and texts without a word have
    neither digest nor license nor notices. Repeated rows come back as often as they are
    there, null ids too, an empty table gives no rows, other columns are ignored.

    Texts are read once and never shuffled: the digests of a document, and of those lines
    that are as long as a known text, are written to a narrow table and joined from there.
    """
    known = cut_lineage(known_digests(known), "license-known")
    # As many values as known texts at most.
    sizes = [r.size for r in known.where("size > 0").select("size").distinct().collect()]
    rows = docs.select("doc_id", _marked(F.col("text")).alias("marked"))
    lines = F.transform(F.split("marked", "\n"), lambda line: F.trim(line))
    of_lines = F.transform(F.filter(lines, lambda line: F.length(line).isin(sizes)), _sha)
    digests = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        _sha(_entire(F.col("marked"))).alias("digest"),
        F.array_distinct(of_lines).alias("of_lines"),
    )
    digests = cut_lineage(digests, "license-digests")
    hits = digests.where(F.size("of_lines") > 0).select("row", F.explode("of_lines").alias("known_digest"))
    notices = (
        hits.join(known.where("size > 0"), "known_digest")
        .groupBy("row")
        .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
    )
    found = digests.join(known.select("known_digest", "license"), F.col("digest") == F.col("known_digest"), "left")
    return found.join(notices, "row", "left").select("doc_id", "digest", "license", "notices")


def scan_notices(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, license): licences of which an entire line of a document is a known text, each once per id.

    Lines of any number and length; null ids count as one id; only hits are grouped.
    """
    found = scan_licenses(docs, known).where("notices IS NOT NULL")
    return found.select("doc_id", F.explode(F.split("notices", ",")).alias("license")).distinct()
