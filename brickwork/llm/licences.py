"""Licence recognition by sentence rules.

A text is cut into sentences, each is normalised (case, white space, comment marks, quotes, years, spelling of
"license"), and those that a known licence sentence matches become its identifier.  Sentences run on over
wrapped lines, without the comment marks of each line; they end at punctuation, at a blank line, around a
copyright notice or SPDX line, and before a line that names a licence by itself after one that did.  A document's identifiers,
in order, are then matched against the licence rules: from left to right, the first rule in the list that
fits the identifiers at that place names a licence and takes them; identifiers between, which no rule fits, are
passed over.  A sentence with a licence word that matches no known sentence is counted as unknown.

Everything happens in one projection over each row; nothing is shuffled.

A sentence that says something is *not* licensed under a licence names none.

Defined cases: NULL and empty texts and those without licence sentences have empty lists; a sentence may name several
licences only by its own identifier; repeats of a licence in a document are listed each time, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts without any of these hold no licence sentence: every pattern of SENTENCES and ABOUT needs one.  No hint
#: holds a blank, as any blank may be a line end.
HINT = r"(?i)licen[cs]e|copyright|\(c\)|©|permission|warrant|redistribut|reserved|\bcc0\b|domain|applicable|\bhope\b|endorse|misrepresented|altered|\bcompile|advertising|\bconfidential|\bperl\b|unauthorized|liable|reproduction"

#: Known licence sentences, as patterns over a normalised sentence; the first that matches counts.  Fixed values.
SENTENCES = [
    ("NotLicensed", r"\bnot (licensed|released|distributed|available) under .*license"),
    ("SpdxApache2", r"spdx-license-identifier: apache-2\.0"),
    ("SpdxMit", r"spdx-license-identifier: mit\b"),
    ("SpdxBsd3", r"spdx-license-identifier: bsd-3-clause"),
    ("SpdxBsd2", r"spdx-license-identifier: bsd-2-clause"),
    ("SpdxLgpl", r"spdx-license-identifier: lgpl-(2|2\.1|3)(\.0)?"),
    ("SpdxGpl3", r"spdx-license-identifier: gpl-3\.0"),
    ("SpdxGpl2", r"spdx-license-identifier: gpl-2\.0"),
    ("SpdxIsc", r"spdx-license-identifier: isc\b"),
    ("SpdxZlib", r"spdx-license-identifier: zlib\b"),
    ("SpdxBoost", r"spdx-license-identifier: bsl-1\.0"),
    ("SpdxUnlicense", r"spdx-license-identifier: unlicense"),
    ("SpdxEpl2", r"spdx-license-identifier: epl-2\.0"),
    ("SpdxEpl1", r"spdx-license-identifier: epl-1\.0"),
    ("SpdxMpl2", r"spdx-license-identifier: mpl-2\.0"),
    ("SpdxAgpl3", r"spdx-license-identifier: agpl-3\.0"),
    ("SpdxCc0", r"spdx-license-identifier: cc0-1\.0"),
    ("SpdxCcBySa", r"spdx-license-identifier: cc-by-sa-4\.0"),
    ("SpdxCcBy", r"spdx-license-identifier: cc-by-4\.0"),
    ("Spdx0Bsd", r"spdx-license-identifier: 0bsd"),
    ("SpdxArtistic2", r"spdx-license-identifier: artistic-2\.0"),
    ("SpdxPostgres", r"spdx-license-identifier: postgresql"),
    ("SpdxMsPl", r"spdx-license-identifier: ms-pl"),
    ("SpdxCddl", r"spdx-license-identifier: cddl-1\.0"),
    ("SpdxWtfpl", r"spdx-license-identifier: wtfpl"),
    ("SpdxOfl", r"spdx-license-identifier: ofl-1\.1"),
    ("CcByNcNd", r"licensed under (the |a )?(cc|creative commons) (by-nc-nd|attribution-noncommercial-noderivatives)\b"),
    ("CcByNcSa", r"licensed under (the |a )?(cc|creative commons) (by-nc-sa|attribution-noncommercial-sharealike)\b"),
    ("CcByNd", r"licensed under (the |a )?(cc|creative commons) (by-nd|attribution-noderivatives)\b"),
    ("CcByNc", r"licensed under (the |a )?(cc|creative commons) (by-nc|attribution-noncommercial)\b"),
    ("CcBySa", r"licensed under (the |a )?(cc|creative commons) (by-sa|attribution-sharealike)\b"),
    ("CcBy", r"licensed under (the |a )?(cc|creative commons) (by|attribution)\b"),
    ("Cc0", r"\bcc0\b|dedicated to the public domain"),
    ("ApacheRef", r"(licensed|released|distributed) under the apache license,? version 2"),
    ("ApacheUse", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing"),
    ("MitRef", r"(licensed|released|distributed) under the (terms of the )?mit license"),
    ("MitGrant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included"),
    ("MitAsIs", r"the software is provided as is, without warranty of any kind"),
    ("Gpl3Later", r"under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 3.* or (\(?at your option\)? )?any later version"),
    ("Gpl2Later", r"under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 2.* or (\(?at your option\)? )?any later version"),
    ("Lgpl3Later", r"gnu (lesser|library) general public license.*version 3.* or (\(?at your option\)? )?any later version"),
    ("Lgpl21Later", r"gnu (lesser|library) general public license.*version 2\.1.* or (\(?at your option\)? )?any later version"),
    ("AgplLater", r"gnu affero general public license.*version 3.* or (\(?at your option\)? )?any later version"),
    ("LgplCopy", r"you should have received a copy of the gnu (lesser|library) general public license"),
    ("AgplCopy", r"you should have received a copy of the gnu affero general public license"),
    ("LgplRef", r"gnu (lesser|library) general public license"),
    ("AgplRef", r"gnu affero general public license"),
    ("Gpl3Ref", r"under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 3"),
    ("Gpl2Ref", r"under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 2"),
    ("GplHope", r"is distributed in the hope that it will be useful"),
    ("GplCopy", r"you should have received a copy of the gnu general public license"),
    ("BsdGrant", r"redistribution and use in source and binary forms, with or without modification"),
    ("BsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BsdNames", r"neither the names? of .* may be used to endorse or promote"),
    ("BsdAsIs", r"this software is provided by (the copyright holders and contributors|.* as is,? and any express or implied warrant)"),
    ("Mpl2Ref", r"subject to the terms of the mozilla public license,? v(ersion|\.) ?2"),
    ("ApacheTitle", r"^apache license,? version 2\.0,? january <year>"),
    ("ApacheTerms", r"^terms and conditions for use, reproduction, and distribution$"),
    ("Gpl3Title", r"^gnu general public license,? version 3,? 29 june <year>"),
    ("Gpl2Title", r"^gnu general public license,? version 2,? june <year>"),
    ("GfdlRef", r"gnu free documentation license"),
    ("IscGrant", r"permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", r"the software is provided as is and the author disclaims all warranties"),
    ("ZlibAsIs", r"this software is provided as-is, without any express or implied warranty"),
    ("ZlibGrant", r"permission is granted to anyone to use this software for any purpose, including commercial applications"),
    ("ZlibOrigin", r"the origin of this software must not be misrepresented"),
    ("ZlibAltered", r"altered source versions must be plainly marked as such"),
    ("ZlibNotice", r"this notice may not be removed or altered from any source distribution"),
    ("BoostRef", r"(licensed|released|distributed) under the boost software license"),
    ("BoostGrant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy"),
    ("UnlicenseDomain", r"this is free and unencumbered software released into the public domain"),
    ("UnlicenseAnyone", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("Epl2Ref", r"eclipse public license,? (- )?(v|version )\.? ?2"),
    ("Epl1Ref", r"eclipse public license,? (- )?(v|version )\.? ?1"),
    ("CddlRef", r"common development and distribution license"),
    ("MsPlRef", r"microsoft public license"),
    ("ArtisticRef", r"artistic license,? (version )?2"),
    ("PerlRef", r"same terms as perl itself"),
    ("PythonRef", r"python software foundation license"),
    ("PostgresGrant", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("PhpRef", r"subject to version 3\.0?1? of the php license"),
    ("EuplRef", r"european union public license"),
    ("OflRef", r"sil open font license"),
    ("OdblRef", r"open database license"),
    ("CdlaRef", r"community data license agreement"),
    ("RailRef", r"openrail(-m|\+\+)? license"),
    ("Mit0Ref", r"mit no attribution license"),
    ("Bsd3Ref", r"under the (terms of the )?(3-clause|new|modified|revised) bsd license"),
    ("Bsd2Ref", r"under the (terms of the )?(2-clause|simplified) bsd license"),
    ("Bsd4Advert", r"all advertising materials mentioning features or use of this software must display"),
    ("BsdEndorse", r"the name of the author may not be used to endorse or promote"),
    ("X11Names", r"except as contained in this notice, the names? of .* shall not be used in advertising"),
    ("LiabilityMit", r"in no event shall the authors or copyright holders be liable for any claim, damages or other liability"),
    ("LiabilityBsd", r"in no event shall the (copyright (holders?|owners?)|regents|authors?) or contributors be liable for any direct, indirect"),
    ("Proprietary", r"(confidential and proprietary|proprietary and confidential)"),
    ("NoCopying", r"unauthorized copying of this file,? via any medium,? is strictly prohibited"),
    ("InDomain", r"(is|are|placed|released) (hereby )?(in|into) the public domain"),
    ("LicenseFile", r"see the (accompanying )?license(\.txt|\.md)? file"),
    ("PatentGrant", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (copyright|patent) license"),
    ("RightsReserved", r"all rights reserved"),
    ("Copyright", r"^(copyright|\(c\)|©)"),
]

#: Licences by the identifiers that name them, in order of trial.  Fixed values.
RULES = [
    ("BSD-4-Clause", "BsdGrant BsdSource BsdBinary Bsd4Advert BsdNames BsdAsIs"),
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdEndorse BsdAsIs"),
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdNames BsdAsIs"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary BsdAsIs"),
    ("Apache-2.0", "ApacheRef ApacheUse ApacheCopy ApacheAsIs"),
    ("Apache-2.0", "ApacheRef ApacheUse"),
    ("Apache-2.0", "ApacheRef"),
    ("X11", "MitGrant MitNotice MitAsIs X11Names"),
    ("X11", "MitGrant MitNotice MitAsIs LiabilityMit X11Names"),
    ("MIT", "MitRef MitGrant MitNotice MitAsIs"),
    ("MIT", "MitGrant MitNotice MitAsIs"),
    ("MIT", "MitRef"),
    ("GPL-3.0-or-later", "Gpl3Later GplHope GplCopy"),
    ("GPL-3.0-or-later", "Gpl3Later"),
    ("GPL-2.0-or-later", "Gpl2Later GplHope GplCopy"),
    ("GPL-2.0-or-later", "Gpl2Later"),
    ("GPL-3.0", "Gpl3Ref GplHope GplCopy"),
    ("GPL-3.0", "Gpl3Ref"),
    ("GPL-2.0", "Gpl2Ref GplHope GplCopy"),
    ("GPL-2.0", "Gpl2Ref"),
    ("LGPL-3.0-or-later", "Lgpl3Later GplHope LgplCopy"),
    ("LGPL-3.0-or-later", "Lgpl3Later"),
    ("LGPL-2.1-or-later", "Lgpl21Later GplHope LgplCopy"),
    ("LGPL-2.1-or-later", "Lgpl21Later"),
    ("AGPL-3.0-or-later", "AgplLater GplHope AgplCopy"),
    ("AGPL-3.0-or-later", "AgplLater"),
    ("LGPL", "LgplRef"),
    ("AGPL-3.0", "AgplRef"),
    ("MPL-2.0", "Mpl2Ref"),
    ("CC-BY-NC", "CcByNc"),
    ("CC-BY-SA", "CcBySa"),
    ("CC-BY", "CcBy"),
    ("CC0-1.0", "Cc0"),
    ("Apache-2.0", "SpdxApache2"),
    ("MIT", "SpdxMit"),
    ("BSD-3-Clause", "SpdxBsd3"),
    ("BSD-2-Clause", "SpdxBsd2"),
    ("LGPL", "SpdxLgpl"),
    ("GPL-3.0", "SpdxGpl3"),
    ("GPL-2.0", "SpdxGpl2"),
    ("Apache-2.0", "ApacheTitle ApacheTerms"),
    ("Apache-2.0", "ApacheTitle"),
    ("GPL-3.0", "Gpl3Title"),
    ("GPL-2.0", "Gpl2Title"),
    ("GFDL", "GfdlRef"),
    ("ISC", "IscGrant IscAsIs"),
    ("ISC", "IscGrant"),
    ("Zlib", "ZlibAsIs ZlibGrant ZlibOrigin ZlibAltered ZlibNotice"),
    ("Zlib", "ZlibGrant"),
    ("BSL-1.0", "BoostRef"),
    ("BSL-1.0", "BoostGrant"),
    ("Unlicense", "UnlicenseDomain UnlicenseAnyone"),
    ("Unlicense", "UnlicenseDomain"),
    ("EPL-2.0", "Epl2Ref"),
    ("EPL-1.0", "Epl1Ref"),
    ("CDDL", "CddlRef"),
    ("MS-PL", "MsPlRef"),
    ("Artistic-2.0", "ArtisticRef"),
    ("Perl", "PerlRef"),
    ("PSF", "PythonRef"),
    ("PostgreSQL", "PostgresGrant"),
    ("PHP-3.01", "PhpRef"),
    ("EUPL", "EuplRef"),
    ("OFL", "OflRef"),
    ("ODbL", "OdblRef"),
    ("CDLA", "CdlaRef"),
    ("OpenRAIL", "RailRef"),
    ("MIT-0", "Mit0Ref"),
    ("BSD-3-Clause", "Bsd3Ref"),
    ("BSD-2-Clause", "Bsd2Ref"),
    ("CC-BY-NC-ND", "CcByNcNd"),
    ("CC-BY-NC-SA", "CcByNcSa"),
    ("CC-BY-ND", "CcByNd"),
    ("ISC", "SpdxIsc"),
    ("Zlib", "SpdxZlib"),
    ("BSL-1.0", "SpdxBoost"),
    ("Unlicense", "SpdxUnlicense"),
    ("EPL-2.0", "SpdxEpl2"),
    ("EPL-1.0", "SpdxEpl1"),
    ("MPL-2.0", "SpdxMpl2"),
    ("AGPL-3.0", "SpdxAgpl3"),
    ("CC0-1.0", "SpdxCc0"),
    ("CC-BY-SA", "SpdxCcBySa"),
    ("CC-BY", "SpdxCcBy"),
    ("0BSD", "Spdx0Bsd"),
    ("Artistic-2.0", "SpdxArtistic2"),
    ("PostgreSQL", "SpdxPostgres"),
    ("MS-PL", "SpdxMsPl"),
    ("CDDL", "SpdxCddl"),
    ("WTFPL", "SpdxWtfpl"),
    ("OFL", "SpdxOfl"),
    ("Proprietary", "Proprietary"),
    ("Proprietary", "NoCopying"),
    ("Public domain", "InDomain"),
    ("All rights reserved", "Copyright RightsReserved"),
    ("All rights reserved", "RightsReserved"),
]

#: A sentence with one of these that is not known counts as unknown.
ABOUT = r"\blicense[ds]?\b|\bcopyright\b|\bwarrant(y|ies)\b|\bredistribut"
UNKNOWN = "Unknown"
_LEAD = r"[\s/*#%;>|!\-]"
#: Not after "v." and not between "Foundation;" and "either version 2".
_END = rf"(?i)((?<!\bv)\.|[!?]|;(?!{_LEAD}+(?:either{_LEAD}+)?version\b))[ \t]+"
_QUOTES = "\"'“”‘’`"
_MARKS = r"^(<!--|[\s/*#%;>|!\-\"'])+|(?<![\s*#|\"'])[\s*#|\"']+$"
#: A copyright notice at the start of a line, not a wrapped line of a sentence about copyright.
_NOTICE = r"(?:copyright|\(c\)|©)(?![,.;:]| (?:notice|holder|owner|law|license|statement|protection|interest|and|or|in|is|are|to|of|as|which|that|for|on)s?\b)"
_ALONE = "|".join(f"(?:{'^' + _NOTICE if name == 'Copyright' else pattern})" for name, pattern in SENTENCES)
#: Marks of a line that is known by itself, and of the end of a sentence.
_KNOWN, _STOP = "\x01", "\x02"


def normalise(line: Column) -> Column:
    """A line or sentence in the form that the patterns are written for."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), r"\s+", " "), _MARKS, "")
    plain = F.translate(plain, _QUOTES, "")
    plain = F.regexp_replace(plain, "licence", "license")
    return F.regexp_replace(plain, r"\b(19|20)[0-9][0-9]\b", "<year>")


def identifier(sentence: Column) -> Column:
    """The identifier of a normalised sentence, NULL for any other."""
    known = [F.when(sentence.rlike(pattern), F.lit(name)) for name, pattern in SENTENCES]
    return F.coalesce(*known, F.when(sentence.rlike(ABOUT), F.lit(UNKNOWN)))


def sentences(text: Column) -> Column:
    """Normalised sentences that may be about licences."""
    cut = F.regexp_replace(F.translate(text, _KNOWN + _STOP, "  "), _END, "$1\n")
    lines = F.transform(F.split(cut, r"\r\n?|\n"), normalise)
    whole = F.array_join(F.transform(lines, lambda s: F.when(s.rlike(HINT) & s.rlike(_ALONE), F.concat(F.lit(_KNOWN), s)).otherwise(s)), "\n")
    whole = F.regexp_replace(whole, r"\n{2,}|(?<=[.!?:]|[.!?;:]\))\n|(?<=;)\n(?!(?:either\s)?version\b)", _STOP)
    whole = F.regexp_replace(whole, rf"\n(?={_KNOWN}?(?:{_NOTICE}|spdx-))", _STOP)
    whole = F.regexp_replace(whole, rf"(?<![^{_STOP}])({_KNOWN}?(?:{_NOTICE}|spdx-)[^\n{_STOP}]*+)\n", "$1" + _STOP)
    whole = F.regexp_replace(whole, rf"({_KNOWN}[^{_KNOWN}{_STOP}]*+)(?={_KNOWN})", "$1" + _STOP)
    whole = F.regexp_replace(F.translate(whole, _KNOWN, ""), r"-\n", "-")
    joined = F.transform(F.split(whole, _STOP), lambda s: F.btrim(F.translate(s, "\n", " ")))
    return F.filter(joined, lambda s: s.rlike(HINT))


def recognise(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, identifiers, licences, n_unknown) of each row."""
    named = F.filter(F.transform(sentences(F.col("_text")), identifier), lambda s: s.isNotNull())
    none = F.array().cast("array<string>")
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text"))
    rows = rows.select("doc_id", F.when(F.translate("_text", _QUOTES, "").rlike(HINT), named).otherwise(none).alias("found"))
    rows = rows.select(
        "doc_id",
        F.coalesce(F.filter("found", lambda s: s != UNKNOWN), none).alias("identifiers"),
        F.coalesce(F.size(F.filter("found", lambda s: s == UNKNOWN)), F.lit(0)).cast("long").alias("n_unknown"),
    )
    any_rule = "|".join(f"(?:{sequence} )" for _, sequence in RULES)
    taken = F.regexp_extract_all(F.concat(F.array_join("identifiers", " "), F.lit(" ")), F.lit(any_rule), F.lit(0))
    names = F.create_map(*[F.lit(x) for name, sequence in RULES for x in (sequence + " ", name)])
    licences = F.when(F.size("identifiers") > 0, F.transform(taken, lambda s: names[s])).otherwise(none)
    return rows.select("doc_id", "identifiers", licences.alias("licences"), "n_unknown")
