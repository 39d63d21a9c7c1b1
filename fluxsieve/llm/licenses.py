"""License scan by ordered signature rules (operator 13).

Rules are regular expressions over a text's words. Their order is their priority: the phrases every result must
hold come first, then texts and notices, then titles, identifiers, addresses, and bare mentions last. A rule is only
tried on texts that hold its keyword, which one Aho-Corasick pass over all keywords finds out. Of overlapping
detections, one that lies within the words of another rule's detection with a higher priority is suppressed, so
"gnu lesser general public license" is no "gnu general public license"; the required phrases are never suppressed.

Words are runs of letters, digits and all non-ASCII characters, A-Z lower-cased. A text becomes `` w1  w2  w3 ``, each
word between two blanks of its own: a blank in a rule stands for the two between neighbours, so matches begin and
end with words, and those that follow one another share no character.

The score is the highest weight of the detections that are left: 1 for a text or notice, 0.9 for an identifier or a
grant that names the license, 0.8 for an address, 0.6 for a title, 0.3 for a bare mention; 0 without any.

Defined results: null text counts as empty, has no words and no detection; ids may be null or repeated, each row is
scanned on its own; an empty table gives an empty result; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fluxsieve.llm.common import identity

TEXT, GRANT, ADDRESS, TITLE, MENTION = 1.0, 0.9, 0.8, 0.6, 0.3

# Fixed values of the contract: phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Sentences of license texts and notices: label, keyword, pattern.
TEXTS = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-0", "without restriction including", "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("mit", "copyright notice and this permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("hpnd", "permission to use copy modify", "permission to use copy modify and distribute this software and its documentation for any purpose( and)? without fee is hereby granted"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause", "endorse or promote products", "(neither )?the names? of .{1,120}? may( not)? be used to endorse or promote products derived from this software"),
    ("bsd-2-clause", "redistributions of source code", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-2-clause", "redistributions in binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2", "except in compliance with the license", "you may not use this (file|work|software) except in compliance with the license"),
    ("apache-2", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", "this product includes software developed by the apache", "this product includes software developed by the apache software foundation"),
    ("gpl-3", "gnu general public license", "under the terms of the gnu general public license as published by the free software foundation (either )?version 3"),
    ("gpl-2", "gnu general public license", "under the terms of the gnu general public license as published by the free software foundation (either )?version 2"),
    ("lgpl-3", "gnu lesser general public license", "under the terms of the gnu lesser general public license as published by the free software foundation (either )?version 3"),
    ("lgpl-2.1", "gnu lesser general public license", "under the terms of the gnu lesser general public license as published by the free software foundation (either )?version 2( 1)?"),
    ("lgpl-2", "gnu library general public license", "under the terms of the gnu library general public license as published by the free software foundation"),
    ("agpl-3", "gnu affero general public license", "under the terms of the gnu affero general public license as published by the free software foundation (either )?version 3"),
    ("gpl", "you should have received a copy", "you should have received a copy of the gnu general public license along with this"),
    ("lgpl", "you should have received a copy", "you should have received a copy of the gnu (lesser|library) general public license along with this"),
    ("agpl", "you should have received a copy", "you should have received a copy of the gnu affero general public license along with this"),
    ("gfdl", "gnu free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "mozilla public license", "this source code form is subject to the terms of the mozilla public license (version |v ?)?2( 0)?"),
    ("mpl-1.1", "mozilla public license", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-2", "incompatible with secondary licenses", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("epl-2", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license (version |v ?)?2( 0)?"),
    ("epl-1", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license (version |v ?)?1( 0)?"),
    ("cddl-1", "common development and distribution", "subject to the terms of the common development and distribution license"),
    ("cpl-1", "common public license", "under the terms of the common public license (version |v ?)?1 0"),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0-1", "waived all copyright", "has waived all copyright and related or neighboring rights"),
    ("cc0-1", "dedicated the work to the public domain", "has dedicated the work to the public domain"),
    ("wtfpl", "you just do what the fuck", "0 you just do what the fuck you want to"),
    ("zlib", "this software is provided as is", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such"),
    ("bsl-1", "boost software license", "distributed under the boost software license version 1 0"),
    ("bsl-1", "use reproduce display distribute execute", "use reproduce display distribute execute and transmit the software and to prepare derivative works of the software"),
    ("ofl-1.1", "sil open font license", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "with reserved font", "with reserved font names?"),
    ("artistic-2", "artistic license", "under the terms of (the )?(either )?(the )?artistic license 2 0"),
    ("artistic-1", "under the same terms as perl", "under the same terms as perl( 5)? itself"),
    ("ms-pl", "you accept this license", "if you use the software you accept this license if you do not accept the license do not use the software"),
    ("psf-2", "psf hereby grants", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "cryptographic software written by", "this product includes cryptographic software written by eric young"),
    ("postgresql", "without a written agreement", "for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", "university of illinois", "permission is hereby granted free of charge .{1,200}? university of illinois"),
    ("x11", "x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("curl", "copyright holder shall not be used in advertising", "except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise"),
    ("vim", "vim without restrictions", "you can distribute .{1,60}? vim without restrictions"),
    ("beerware", "buy me a beer", "you can buy me a beer in return"),
    ("jslint", "used for good not evil", "the software shall be used for good not evil"),
    ("sspl-1", "server side public license", "under the terms of the server side public license version 1"),
    ("busl-1.1", "business source license", "use of this software is governed by the business source license"),
    ("elastic-2", "hosted or managed service", "you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "does not grant to you", "the license does not grant to you the right to sell the software"),
    ("eupl-1.2", "under the eupl", "licensed under the eupl (version |v ?)?1 2"),
    ("odbl-1", "open database license", "made available under the open database license"),
    ("pddl-1", "public domain dedication and license", "made available under the public domain dedication and license"),
    ("proprietary", "confidential and proprietary", "confidential and proprietary (information|property) of"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this (file|software|document)"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved no part of this (work|publication|book|document) may be reproduced"),
    ("no-ai", "may not be used", "may not be used (to train|for training|in the training of) (any )?(artificial intelligence|machine learning|language models?|ai)"),
    ("public-domain", "public domain", "(is|are|was|were|has been|have been) (hereby )?(placed|released|dedicated) (in|into|to) the public domain"),
    ("us-government", "of the united states government", "(is|are) (a )?works? of the united states government"),
)

#: What licenses are called: label, keyword of the name, pattern of the name. Longer names before those they hold.
NAMES = (
    ("agpl-3", "affero general public license", "(gnu )?affero general public license (as published by the free software foundation )?(version |v ?)?3( 0)?"),
    ("agpl", "affero general public license", "(gnu )?affero general public license"),
    ("agpl-3", "agplv3", "agplv3"), ("agpl-3", "agpl", "agpl (version |v ?)?3( 0)?"), ("agpl", "agpl", "gnu agpl"),
    ("lgpl-3", "lesser general public license", "(gnu )?lesser general public license (version |v ?)?3( 0)?"),
    ("lgpl-2.1", "lesser general public license", "(gnu )?lesser general public license (version |v ?)?2 1"),
    ("lgpl", "lesser general public license", "(gnu )?lesser general public license"),
    ("lgpl-2", "library general public license", "(gnu )?library general public license"),
    ("lgpl-3", "lgplv3", "lgplv3"), ("lgpl-2.1", "lgplv2", "lgplv2 1"), ("lgpl-3", "lgpl", "lgpl (version |v ?)?3( 0)?"),
    ("lgpl-2.1", "lgpl", "lgpl (version |v ?)?2 1"), ("lgpl", "lgpl", "gnu lgpl"),
    ("gpl-3", "general public license", "(gnu )?general public license (version |v ?)?3( 0)?"),
    ("gpl-2", "general public license", "(gnu )?general public license (version |v ?)?2( 0)?"),
    ("gpl", "general public license", "(gnu )?general public license"),
    ("gpl-3", "gplv3", "gplv3"), ("gpl-2", "gplv2", "gplv2"), ("gpl-3", "gpl", "gpl (version |v ?)?3( 0)?"),
    ("gpl-2", "gpl", "gpl (version |v ?)?2( 0)?"), ("gpl", "gpl", "gnu gpl"),
    ("gfdl", "free documentation license", "(gnu )?free documentation license"),
    ("apache-2", "apache", "apache (software )?license (version |v ?)?2( 0)?"), ("apache-1.1", "apache", "apache (software )?license (version |v ?)?1 1"),
    ("apache", "apache", "apache (software )?license"), ("apache-2", "asl", "asl 2 0"),
    ("mit-0", "mit no attribution", "mit no attribution"), ("mit", "mit license", "(the )?(expat )?mit license"),
    ("mit", "expat license", "expat license"), ("x11", "x11 license", "(mit )?x11 license"),
    ("bsd-4-clause", "bsd", "(4|four) clause bsd( license)?"), ("bsd-3-clause", "bsd", "(3|three) clause bsd( license)?"),
    ("bsd-2-clause", "bsd", "(2|two) clause bsd( license)?"), ("bsd-4-clause", "original bsd license", "original bsd license"),
    ("bsd-3-clause", "bsd", "((new|modified|revised) bsd|bsd (3|three) clause)( license)?"),
    ("bsd-2-clause", "bsd", "((simplified|freebsd) bsd|bsd (2|two) clause)( license)?"),
    ("0bsd", "bsd", "(zero clause bsd|bsd zero clause)( license)?"), ("bsd", "bsd", "bsd (style )?license"),
    ("isc", "isc license", "isc license"), ("ncsa", "ncsa open source license", "(university of illinois )?ncsa open source license"),
    ("mpl-2", "mozilla public license", "mozilla public license (version |v ?)?2( 0)?"),
    ("mpl-1.1", "mozilla public license", "mozilla public license (version |v ?)?1 1"),
    ("mpl", "mozilla public license", "mozilla public license"), ("mpl-2", "mplv2", "mplv2( 0)?"), ("mpl-2", "mpl", "mpl (version |v ?)?2 0"),
    ("epl-2", "eclipse public license", "eclipse public license (version |v ?)?2( 0)?"),
    ("epl-1", "eclipse public license", "eclipse public license (version |v ?)?1( 0)?"), ("epl", "eclipse public license", "eclipse public license"),
    ("edl-1", "eclipse distribution license", "eclipse distribution license"),
    ("cddl-1.1", "common development and distribution license", "common development and distribution license (version |v ?)?1 1"),
    ("cddl-1", "common development and distribution license", "common development and distribution license"),
    ("cpl-1", "common public license", "common public license"), ("ipl-1", "ibm public license", "ibm public license"),
    ("bsl-1", "boost software license", "boost software license"), ("zlib", "zlib", "zlib (libpng )?license"),
    ("libpng", "libpng license", "libpng license"), ("unlicense", "the unlicense", "the unlicense"), ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("artistic-2", "artistic license", "artistic license (version |v ?)?2( 0)?"), ("artistic-1", "artistic license", "artistic license"),
    ("psf-2", "python software foundation license", "python software foundation license"), ("python-2", "python license", "python license"),
    ("ruby", "ruby license", "ruby license"), ("php-3", "php license", "php license"), ("zpl-2.1", "zope public license", "zope public license"),
    ("ofl-1.1", "open font license", "(sil )?open font license"), ("openssl", "openssl license", "openssl license"),
    ("postgresql", "postgresql license", "postgresql license"), ("ms-pl", "microsoft public license", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license"), ("eupl-1.2", "european union public", "european union public licen[cs]e"),
    ("cecill", "cecill", "cecill( license)?"), ("qpl-1", "q public license", "q public license"), ("afl-3", "academic free license", "academic free license"),
    ("osl-3", "open software license", "open software license"), ("upl-1", "universal permissive license", "universal permissive license"),
    ("mulan-2", "mulan", "mulan (psl|permissive software license)"), ("bluejeans", "blue oak model license", "blue oak model license"),
    ("sspl-1", "server side public license", "server side public license"), ("busl-1.1", "business source license", "business source license"),
    ("elastic-2", "elastic license", "elastic license"), ("commons-clause", "commons clause", "commons clause"),
    ("polyform", "polyform", "polyform (noncommercial|small business|shield|perimeter|strict|free trial)( license)?"),
    ("openrail", "openrail", "(creativeml |bigscience )?openrail( m)?"), ("llama", "community license", "llama (2 |3 )?community license"),
    ("odbl-1", "open database license", "open database license"), ("odc-by-1", "open data commons attribution", "open data commons attribution license"),
    ("pddl-1", "public domain dedication and license", "public domain dedication and license"),
    ("cdla-permissive", "community data license agreement", "community data license agreement permissive"),
    ("cdla-sharing", "community data license agreement", "community data license agreement sharing"),
    ("ogl-uk-3", "open government", "open government licen[cs]e"),
    ("cc0-1", "cc0", "cc0( 1 0)?( universal)?"), ("cc0-1", "creative commons zero", "creative commons zero"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(ative)?s?( works)?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike"),
    ("cc-by", "creative commons", "creative commons attribution"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd"), ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa"),
    ("cc-by-nd", "cc by nd", "cc by nd"), ("cc-by-sa", "cc by sa", "cc by sa"), ("cc-by", "cc by", "cc by( [1-4] 0)?"),
    ("creative-commons", "creative commons", "creative commons( licen[cs]es?)?"),
)

#: Addresses, as words: label, keyword, pattern.
ADDRESSES = (
    ("mit", "opensource org", "opensource org licenses? mit( license)?"), ("apache-2", "apache org", "(www )?apache org licenses license 2 0"),
    ("bsd-3-clause", "opensource org", "opensource org licenses? bsd 3 clause"), ("bsd-2-clause", "opensource org", "opensource org licenses? bsd 2 clause"),
    ("bsd", "opensource org", "opensource org licenses? bsd license"), ("isc", "opensource org", "opensource org licenses? isc"),
    ("gpl-3", "gnu org", "(www )?gnu org licenses gpl 3 0"), ("gpl-2", "gnu org", "(www )?gnu org licenses (old licenses )?gpl 2 0"),
    ("gpl", "gnu org", "(www )?gnu org licenses( gpl)?"), ("lgpl", "gnu org", "(www )?gnu org licenses lgpl( 3 0| 2 1)?"),
    ("agpl-3", "gnu org", "(www )?gnu org licenses agpl( 3 0)?"), ("gfdl", "gnu org", "(www )?gnu org licenses fdl( 1 [1-3])?"),
    ("mpl-2", "mozilla org", "mozilla org (en us )?mpl 2 0"), ("epl-2", "eclipse org", "(www )?eclipse org legal epl (2 0|v20)"),
    ("epl-1", "eclipse org", "(www )?eclipse org legal epl v10"), ("bsl-1", "boost org", "(www )?boost org license 1 0"),
    ("unlicense", "unlicense org", "unlicense org"), ("wtfpl", "wtfpl net", "(www )?wtfpl net"), ("ofl-1.1", "scripts sil org", "scripts sil org ofl"),
    ("cc0-1", "creativecommons org", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons org", "creativecommons org publicdomain mark 1 0"),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd"), ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa"),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc"), ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd"),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa"), ("cc-by", "creativecommons org", "creativecommons org licenses by"),
    ("odbl-1", "opendatacommons org", "opendatacommons org licenses odbl"), ("pddl-1", "opendatacommons org", "opendatacommons org licenses pddl"),
)

#: Bare mentions: label, keyword, pattern.
MENTIONS = (
    ("all-rights-reserved", "all rights reserved", "all rights reserved"), ("public-domain", "public domain", "(in|into) the public domain"),
    ("copyleft", "copyleft", "copyleft"), ("proprietary", "proprietary", "proprietary licen[cs]e"),
    ("commercial", "commercial", "commercial licen[cs]e"), ("non-commercial", "use only", "(for )?non ?commercial use only"),
    ("open-source", "open source", "open source licen[cs]es?"), ("freeware", "freeware", "freeware"), ("shareware", "shareware", "shareware"),
    ("eula", "end user", "end user licen[cs]e agreement"), ("copyright", "copyright", "copyright (c |© )?(19|20)[0-9][0-9]"),
    ("no-license", "is granted", "no licen[cs]e is granted"), ("dual-license", "dual licensed", "dual licensed( under)?"),
    ("tos", "terms of service", "subject to (the |our )?terms of service"), ("permission", "permission", "used (by|with) (kind )?permission"),
)

#: Words of an identifier tag, by label where they differ from the label's own.
IDENTIFIERS = {"gpl": "gpl", "bluejeans": "blueoak 1 0 0", "llama": "llama", "apache-2": "apache 2 0", "mpl-2": "mpl 2 0", "epl-2": "epl 2 0"}
_GRANT = ("(licensed|released|distributed|available|published|provided|offered|redistributed|shared) "
          "under (the )?(terms of )?(the )?(conditions of )?(the )?")


class Rule(NamedTuple):
    """One signature; a rule's number in the list is its priority."""

    label: str
    weight: float
    keyword: str
    pattern: str


def spaced(words: str) -> str:
    """Words or a pattern of words in the form a scanned text has: each word between two blanks of its own."""
    return " " + words.replace(" ", "  ") + " "


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority: the required phrases, texts, tags, grants, addresses, names, mentions."""
    labels = dict.fromkeys(n[0] for n in NAMES)
    tag = "spdx license identifier"
    out = [(label, TEXT, phrase, phrase) for phrase, label in BASE]
    out += [(label, TEXT, k, p) for label, k, p in TEXTS]
    # longer identifiers first: where two begin at one place, the longer one holds the other
    tags = sorted(((label, IDENTIFIERS.get(label, label.replace("-", " ").replace(".", " "))) for label in labels),
                  key=lambda t: (-len(t[1]), t))
    out += [(label, GRANT, tag, f"{tag} {words}( 0)?( only| or later)?") for label, words in tags]
    out += [(label, GRANT, k, f"{_GRANT}(version [1-3] of the )?({p})") for label, k, p in NAMES]
    out += [(label, ADDRESS, k, p) for label, k, p in ADDRESSES]
    out += [(label, TITLE, k, p) for label, k, p in NAMES]
    out += [(label, MENTION, k, p) for label, k, p in MENTIONS]
    return tuple(Rule(label, weight, spaced(k), spaced(_doubled(p))) for label, weight, k, p in out)


def _doubled(pattern: str) -> str:
    """An optional blank inside a word pair (``non ?commercial``) as an optional pair of blanks."""
    return pattern.replace(" ?", "( )?")


#: Bytes to words: A-Z lower-cased, digits, letters and all bytes beyond ASCII kept, others blank.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[str]:
    return (text or "").encode().translate(_WORD_BYTES).decode().split(" ") if text else []


class Scanner:
    """Compiled rules behind one automaton of their keywords."""

    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.compiled = [re.compile(r.pattern) for r in self.rules]
        by_keyword: dict[str, list[int]] = {}
        for number, rule in enumerate(self.rules):
            by_keyword.setdefault(rule.keyword, []).append(number)
        self.keywords = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self.keywords.add_word(keyword, numbers)
        self.keywords.make_automaton()

    def detections(self, text: str | None) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and (start word, end word, rule) of every match, suppressed or not."""
        words = [w for w in words_of(text) if w]
        held = spaced(" ".join(words)) if words else ""
        tried = sorted({n for _, numbers in self.keywords.iter(held) for n in numbers})
        if not tried:
            return len(words), []
        begins = np.cumsum([0, *(len(w) + 2 for w in words)])  # of each word's own leading blank
        found = []
        for n in tried:
            at = np.array([m.span() for m in self.compiled[n].finditer(held)], np.int64).reshape(-1, 2)
            found += [(s, e, n) for s, e in np.searchsorted(begins, at).tolist()]
        return len(words), found


def surviving(found: list[tuple[int, int, int]], required: int = len(BASE)) -> list[tuple[int, int, int]]:
    """Detections that lie in no detection of an earlier rule; the required ones all stay.

    Rules are taken in order; a tree over start words holds the furthest end so far, so n detections take
    n log n steps.
    """
    order = sorted(found, key=lambda d: d[2])
    place = {s: i + 1 for i, s in enumerate(sorted({s for s, _, _ in found}))}
    furthest, out, i = [0] * (len(place) + 1), [], 0
    while i < len(order):
        same = i
        while same < len(order) and order[same][2] == order[i][2]:
            same += 1
        for s, e, n in order[i:same]:
            k, most = place[s], 0
            while k:
                most, k = max(most, furthest[k]), k & (k - 1)
            if n < required or most < e:
                out.append((s, e, n))
        for s, e, _ in order[i:same]:
            k = place[s]
            while k <= len(place):
                furthest[k], k = max(furthest[k], e), k + (k & -k)
        i = same
    return sorted(out)


@lru_cache(1)
def scanner() -> Scanner:
    return Scanner()


_FOUND = "array<struct<start:long,end:long,rule:int,label:string,weight:double>>"


def scan(docs: DataFrame) -> DataFrame:
    """id, text_key, n_words and the surviving detections (start, end in words, rule, label, weight) of every row."""

    def run(batches):
        own = scanner()
        for batch in batches:
            n_words, ends, flat = [], [0], []
            for text in batch.column("text"):
                n, found = own.detections(text.as_py())
                n_words.append(n)
                flat += surviving(found)
                ends.append(len(flat))
            start, end, rule = zip(*flat) if flat else ((), (), ())
            fields = pa.StructArray.from_arrays(
                [pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(rule, pa.int32()),
                 pa.array([own.rules[r].label for r in rule], pa.string()), pa.array([own.rules[r].weight for r in rule], pa.float64())],
                ["start", "end", "rule", "label", "weight"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n_words, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)], ["id", "text_key", "n_words", "found"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(*identity(), F.col("text")).mapInArrow(
        run, f"id {kind}, text_key long, n_words long, found {_FOUND}")


def labelled(docs: DataFrame) -> DataFrame:
    """``scan`` with the labels of all surviving detections (distinct, sorted) and the score."""
    each = lambda c: F.transform("found", lambda d: d[c])
    return scan(docs).withColumns({
        "labels": F.array_sort(F.array_distinct(each("label"))),
        "score": F.coalesce(F.array_max(each("weight")), F.lit(0.0))})
