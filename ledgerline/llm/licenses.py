"""Licence scan by canonical digests: whole texts that are a known licence, whatever their spelling and layout.

A text is brought to a canonical form (case, copyright lines, punctuation, equivalent spellings) and
hashed; digests are joined to those of the known texts. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Typographic punctuation outside ASCII, each taken as a space (the copyright sign as a letter).
TYPOGRAPHIC = "‘’“”–—…\u00a0«»•·\ufeff"
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n©]*(copyright|\(c\)|©|all rights reserved|portions copyright)[^\n]*"
NOT_WORD = r"[\x00-/:-`{-\x7f]+"
# Equivalent spellings by rule: pattern, replacement. Applied to both sides, in this order.
SPELLINGS = [
    (r"\b(sub|non|co|re|multi) (licens|licenc|commercial|owner|distribut|use)", r"$1$2"),
    (r"\b([a-z]*licen|defen|offen|preten)ce", r"$1se"),
    (r"([a-z]{3})is(e|ed|es|er|ers|ing|ation|ations)\b", r"$1iz$2"),
    (r"\b(analy|cataly)s(e|ed|es|ing)\b", r"$1z$2"),
    (r"\b([a-z]*)(favo|hono|labo|colo|behavio)ur", r"$1$2r"),
    (r"\b(cata|ana|dia)logue", r"$1log"),
    (r"\b(centr|fibr|theatr|lit|met)re\b", r"$1er"),
    (r"\b(acknowledg|judg)ement", r"$1ment"),
    (r"\b(cancel|label|model|signal|travel)l(ed|ing|er)\b", r"$1$2"),
    (r"\bwhilst\b", "while"),
    (r"\bper cent\b", "percent"),
    (r"\b(fulfil|wilful|skilful)l?", r"$1"),
    (r"\bcopyright owner", "copyright holder"),
]

# Texts of common short licences and their notices, without their copyright lines.
KNOWN = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
}
#: Known digests are broadcast up to this many; a larger registry is joined by shuffling digests.
BROADCAST_ROWS = 100_000


def canonical(text):
    """Column: the text in ASCII lower case, without copyright lines, punctuation as single spaces, one spelling."""
    text = F.translate(text, UPPER, LOWER)
    text = F.regexp_replace(text, COPYRIGHT_LINE, "$1")
    text = F.translate(text, TYPOGRAPHIC, " " * len(TYPOGRAPHIC))
    text = F.trim(F.regexp_replace(text, NOT_WORD, " "))
    for pattern, spelling in SPELLINGS:
        text = F.regexp_replace(text, pattern, spelling)
    return text


def known_digests(registry: DataFrame) -> DataFrame:
    """(license_id, canonical_sha256) of a registry (license_id, text); of equal texts the first id, empty ones left out."""
    return (registry.select("license_id", canonical(F.col("text")).alias("canonical")).filter("canonical != ''")
            .groupBy(F.sha2("canonical", 256).alias("canonical_sha256")).agg(F.min("license_id").alias("license_id")))


def scan(df: DataFrame, registry: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` plus ``canonical_sha256`` and ``license_id`` (null: the text is no known licence).

    Whole texts are compared, however long; null counts as empty, and the empty text is no licence. Rows
    are independent, so repeated rows stay and an empty frame gives an empty frame. Existing columns of
    these two names are replaced.
    """
    if registry is None:
        registry = df.sparkSession.createDataFrame(sorted(KNOWN.items()), "license_id string, text string")
    known = known_digests(registry)
    if registry.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    kept = [c for c in df.columns if c not in ("canonical_sha256", "license_id")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digested = df.select(*(F.col(f"`{c}`") for c in kept), F.sha2(canonical(text), 256).alias("canonical_sha256"))
    return digested.join(known, "canonical_sha256", "left").select(*(F.col(f"`{c}`") for c in kept), "canonical_sha256", "license_id")
