"""Known licence texts by canonical digest; DataFrame functions only."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from outledger.llm import frames

# Wordings of public licences and of their notices.
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the
License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "MIT-notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event
will the authors be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated
but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any
source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": ["""This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to
be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to
be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to
<https://unlicense.org>""", """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and
all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to
be an overt act of relinquishment in perpetuity of all present and future rights to this software
under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to
<http://unlicense.org/>"""],
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-short-notice": "Licensed under CC BY 4.0.",
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0-notice": "Licensed under the Creative Commons Attribution 4.0 International License.",
}

#: Whole public licences, one file each.
TEXTS = Path(__file__).parent / "license_texts"


def wordings(text: str) -> list[str]:
    """A whole licence with and without its title paragraph, and with and without what follows the terms."""
    ends = [text, *(text[: m.end()] for m in re.finditer(r"END OF TERMS AND CONDITIONS", text))]
    return ends + [re.split(r"\n[ \t]*\n", x.strip(), maxsplit=1)[-1] for x in ends]


def known_texts() -> dict[str, str | list[str]]:
    """KNOWN and the whole licences of the files."""
    return KNOWN | {p.stem: wordings(p.read_text("utf-8", "replace").replace("\f", "\n")) for p in sorted(TEXTS.glob("*.txt"))}


# Equivalent spellings, as they stand after case and punctuation are gone.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub license": "sublicense",
    "non infringement": "noninfringement", "organisation": "organization", "favour": "favor",
    "authorisation": "authorization", "judgement": "judgment", "acknowledgement": "acknowledgment",
    "analogue": "analog", "centre": "center", "per cent": "percent", "whilst": "while",
    "https": "http", "copyright holder": "copyright owner", "copyright holders": "copyright owners",
}
COPYRIGHT_LINE = (
    r"^[\s/*#;%-]*((copyright[ \t]*(\(c\)|©|[0-9]|by )|\(c\)[ \t]*[0-9]|©).*|all rights reserved\.?[ \t]*)$"
)
# A line that only names the licence of the text below it.
TITLE_LINE = (
    r"^[\s/*#;%=-]*(the[ \t]+)?(mit|expat|x11|isc|zlib|bsd|(new|simplified|modified|revised)[ \t]+bsd|"
    r"(bsd[ \t]+)?[23]-clause([ \t]+[\"']?(new|simplified|revised)[\"']?)?([ \t]+or[ \t]+[\"'](revised|new)[\"'])?([ \t]+bsd)?)"
    r"[ \t]+licen[sc]e([ \t]*\([^()]*\))?[\s:.*/#=-]*$|^[\s/*#;%=-]*the[ \t]+unlicense[\s.:]*$"
)
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def plain(text: str | Column) -> Column:
    """Lower case, words (letters and digits) and single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), BETWEEN_WORDS, " "))


def spelled(text: str | Column) -> Column:
    """Plain text in one spelling; one look decides whether a text needs the replacements."""
    text = F.col(text) if isinstance(text, str) else text
    chosen = text
    for other, spelling in SPELLINGS.items():
        chosen = F.regexp_replace(chosen, rf"\b{other}\b", spelling)
    return F.when(text.rlike(rf"\b({'|'.join(SPELLINGS)})\b"), chosen).otherwise(text)


def canonical_units(df: DataFrame, text_col: str) -> DataFrame:
    """`units`: plain forms of the whole text (first), its paragraphs and its lines.

    Paragraphs are divided by blank lines; they and lines are listed only where there are several.
    Copyright lines become empty: those that begin, after comment signs, with "copyright" and a
    year, a sign or "by", with "(c)" and a year, or with the sign; or say "all rights reserved". So do lines that only name a short licence ("MIT License").
    """
    line = lambda x: F.when(F.trim(x) == "", "\n").when(F.lower(x).rlike(f"{COPYRIGHT_LINE}|{TITLE_LINE}"), "").otherwise(plain(x))
    text = F.translate(F.coalesce(text_col, F.lit("")), "\r", "")
    several = lambda parts: F.when(F.size(parts) > 1, F.col(parts)).otherwise(F.array().cast("array<string>"))
    # Step by step, so that no list is made twice.
    return (
        df.withColumn("_lines", F.transform(F.split(text, "\n"), line))
        .withColumn("_lines", F.filter("_lines", lambda x: x != ""))
        .withColumn("_joined", F.array_join("_lines", " "))
        .withColumn("_paragraphs", F.split("_joined", " *(\n *)+"))
        .withColumn("_whole", F.trim(F.replace(F.replace("_joined", F.lit("\n "), F.lit("")), F.lit("\n"), F.lit(""))))
        .withColumn("units", F.concat(F.array("_whole"), several("_paragraphs"), several("_lines")))
        .drop("_lines", "_joined", "_paragraphs", "_whole")
    )


def known_digests(spark: SparkSession, texts: dict[str, str | list[str]] | None = None) -> DataFrame:
    """digest, license_id and length of the known texts; of equal texts the first id by name.

    An id has one text or a list of wordings.
    """
    each = [(k, t) for k, v in (texts or known_texts()).items() for t in ([v] if isinstance(v, str) else v)]
    rows = spark.createDataFrame(sorted(each), "license_id string, text string")
    whole = canonical_units(rows, "text").select("license_id", spelled(F.col("units")[0]).alias("whole"))
    return whole.groupBy(F.sha2("whole", 256).alias("digest")).agg(
        F.min("license_id").alias("license_id"), F.max(F.length("whole")).alias("length")
    )


def license_scan(
    df: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, license_id (of the whole text), licenses and n_matches of every row.

    The whole text, each paragraph (between blank lines) and each line is a unit; its canonical form
    is hashed and joined with the digests of known texts. `licenses` lists the ids found,
    comma-joined in order, `n_matches` counts the units that matched, a unit that covers the whole
    text or a whole paragraph once. `known` (from known_digests) is joined by hash; Spark broadcasts
    it while it is small.

    NULL and empty texts match nothing; NULL ids and repeated rows are kept, each with its own
    text's result; an empty `known` or `df` is no special case; other columns are not read.
    """
    docs = frames.pick(df, doc_id=id_col, text=text_col)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    # No spelling shortens a text by more than a fifth, so a longer unit can't be a known text.
    longest = known.agg(F.max("length")).first()[0] or 0
    each = (
        canonical_units(docs.withColumn("text_key", key), "text")
        .select("doc_id", "text_key", F.posexplode("units").alias("unit", "part"))
        .filter((F.length("part") > 0) & (F.col("part") != "\n") & (F.length("part") * 4 <= 5 * longest))
        .select("doc_id", "text_key", "unit", F.sha2(spelled("part"), 256).alias("digest"))
    )
    hits = (
        each.join(known.select("digest", "license_id"), "digest")
        .select("doc_id", "text_key", "unit", "license_id")
        .distinct()
        .groupBy("doc_id", "text_key")
        .agg(
            F.min(F.when(F.col("unit") == 0, F.col("license_id"))).alias("license_id"),
            F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("licenses"),
            F.count("*").alias("n_matches"),
        )
        .withColumnsRenamed({"doc_id": "hit_id", "text_key": "hit_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    return docs.select("doc_id", key.alias("text_key")).join(hits, same, "left").select(
        "doc_id", "license_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
    )
