"""DuckDB twin of the licence query, with its own copy of the fixed patterns and rules."""

SQL = r"""
WITH known(place, name, pattern) AS (VALUES
    (1, 'NotLicensed', '\bnot (licensed|released|distributed|available) under .*license'),
    (2, 'SpdxApache2', 'spdx-license-identifier: apache-2\.0'),
    (3, 'SpdxMit', 'spdx-license-identifier: mit\b'),
    (4, 'SpdxBsd3', 'spdx-license-identifier: bsd-3-clause'),
    (5, 'SpdxBsd2', 'spdx-license-identifier: bsd-2-clause'),
    (6, 'SpdxLgpl', 'spdx-license-identifier: lgpl-(2|2\.1|3)(\.0)?'),
    (7, 'SpdxGpl3', 'spdx-license-identifier: gpl-3\.0'),
    (8, 'SpdxGpl2', 'spdx-license-identifier: gpl-2\.0'),
    (9, 'SpdxIsc', 'spdx-license-identifier: isc\b'),
    (10, 'SpdxZlib', 'spdx-license-identifier: zlib\b'),
    (11, 'SpdxBoost', 'spdx-license-identifier: bsl-1\.0'),
    (12, 'SpdxUnlicense', 'spdx-license-identifier: unlicense'),
    (13, 'SpdxEpl2', 'spdx-license-identifier: epl-2\.0'),
    (14, 'SpdxEpl1', 'spdx-license-identifier: epl-1\.0'),
    (15, 'SpdxMpl2', 'spdx-license-identifier: mpl-2\.0'),
    (16, 'SpdxAgpl3', 'spdx-license-identifier: agpl-3\.0'),
    (17, 'SpdxCc0', 'spdx-license-identifier: cc0-1\.0'),
    (18, 'SpdxCcBySa', 'spdx-license-identifier: cc-by-sa-4\.0'),
    (19, 'SpdxCcBy', 'spdx-license-identifier: cc-by-4\.0'),
    (20, 'Spdx0Bsd', 'spdx-license-identifier: 0bsd'),
    (21, 'SpdxArtistic2', 'spdx-license-identifier: artistic-2\.0'),
    (22, 'SpdxPostgres', 'spdx-license-identifier: postgresql'),
    (23, 'SpdxMsPl', 'spdx-license-identifier: ms-pl'),
    (24, 'SpdxCddl', 'spdx-license-identifier: cddl-1\.0'),
    (25, 'SpdxWtfpl', 'spdx-license-identifier: wtfpl'),
    (26, 'SpdxOfl', 'spdx-license-identifier: ofl-1\.1'),
    (27, 'CcByNcNd', 'licensed under (the |a )?(cc|creative commons) (by-nc-nd|attribution-noncommercial-noderivatives)\b'),
    (28, 'CcByNcSa', 'licensed under (the |a )?(cc|creative commons) (by-nc-sa|attribution-noncommercial-sharealike)\b'),
    (29, 'CcByNd', 'licensed under (the |a )?(cc|creative commons) (by-nd|attribution-noderivatives)\b'),
    (30, 'CcByNc', 'licensed under (the |a )?(cc|creative commons) (by-nc|attribution-noncommercial)\b'),
    (31, 'CcBySa', 'licensed under (the |a )?(cc|creative commons) (by-sa|attribution-sharealike)\b'),
    (32, 'CcBy', 'licensed under (the |a )?(cc|creative commons) (by|attribution)\b'),
    (33, 'Cc0', '\bcc0\b|dedicated to the public domain'),
    (34, 'ApacheRef', '(licensed|released|distributed) under the apache license,? version 2'),
    (35, 'ApacheUse', 'you may not use this file except in compliance with the license'),
    (36, 'ApacheCopy', 'you may obtain a copy of the license at'),
    (37, 'ApacheAsIs', 'unless required by applicable law or agreed to in writing'),
    (38, 'MitRef', '(licensed|released|distributed) under the (terms of the )?mit license'),
    (39, 'MitGrant', 'permission is hereby granted, free of charge, to any person obtaining a copy'),
    (40, 'MitNotice', 'the above copyright notice and this permission notice shall be included'),
    (41, 'MitAsIs', 'the software is provided as is, without warranty of any kind'),
    (42, 'Gpl3Later', 'under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 3.* or (\(?at your option\)? )?any later version'),
    (43, 'Gpl2Later', 'under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 2.* or (\(?at your option\)? )?any later version'),
    (44, 'Lgpl3Later', 'gnu (lesser|library) general public license.*version 3.* or (\(?at your option\)? )?any later version'),
    (45, 'Lgpl21Later', 'gnu (lesser|library) general public license.*version 2\.1.* or (\(?at your option\)? )?any later version'),
    (46, 'AgplLater', 'gnu affero general public license.*version 3.* or (\(?at your option\)? )?any later version'),
    (47, 'LgplCopy', 'you should have received a copy of the gnu (lesser|library) general public license'),
    (48, 'AgplCopy', 'you should have received a copy of the gnu affero general public license'),
    (49, 'LgplRef', 'gnu (lesser|library) general public license'),
    (50, 'AgplRef', 'gnu affero general public license'),
    (51, 'Gpl3Ref', 'under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 3'),
    (52, 'Gpl2Ref', 'under the (terms of the )?gnu general public license,? (as published by the free software foundation[;,] (either )?)?version 2'),
    (53, 'GplHope', 'is distributed in the hope that it will be useful'),
    (54, 'GplCopy', 'you should have received a copy of the gnu general public license'),
    (55, 'BsdGrant', 'redistribution and use in source and binary forms, with or without modification'),
    (56, 'BsdSource', 'redistributions of source code must retain the above copyright notice'),
    (57, 'BsdBinary', 'redistributions in binary form must reproduce the above copyright notice'),
    (58, 'BsdNames', 'neither the names? of .* may be used to endorse or promote'),
    (59, 'BsdAsIs', 'this software is provided by (the copyright holders and contributors|.* as is,? and any express or implied warrant)'),
    (60, 'Mpl2Ref', 'subject to the terms of the mozilla public license,? v(ersion|\.) ?2'),
    (61, 'ApacheTitle', '^apache license,? version 2\.0,? january <year>'),
    (62, 'ApacheTerms', '^terms and conditions for use, reproduction, and distribution$'),
    (63, 'Gpl3Title', '^gnu general public license,? version 3,? 29 june <year>'),
    (64, 'Gpl2Title', '^gnu general public license,? version 2,? june <year>'),
    (65, 'GfdlRef', 'gnu free documentation license'),
    (66, 'IscGrant', 'permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted'),
    (67, 'IscAsIs', 'the software is provided as is and the author disclaims all warranties'),
    (68, 'ZlibAsIs', 'this software is provided as-is, without any express or implied warranty'),
    (69, 'ZlibGrant', 'permission is granted to anyone to use this software for any purpose, including commercial applications'),
    (70, 'ZlibOrigin', 'the origin of this software must not be misrepresented'),
    (71, 'ZlibAltered', 'altered source versions must be plainly marked as such'),
    (72, 'ZlibNotice', 'this notice may not be removed or altered from any source distribution'),
    (73, 'BoostRef', '(licensed|released|distributed) under the boost software license'),
    (74, 'BoostGrant', 'permission is hereby granted, free of charge, to any person or organization obtaining a copy'),
    (75, 'UnlicenseDomain', 'this is free and unencumbered software released into the public domain'),
    (76, 'UnlicenseAnyone', 'anyone is free to copy, modify, publish, use, compile, sell, or distribute this software'),
    (77, 'Epl2Ref', 'eclipse public license,? (- )?(v|version )\.? ?2'),
    (78, 'Epl1Ref', 'eclipse public license,? (- )?(v|version )\.? ?1'),
    (79, 'CddlRef', 'common development and distribution license'),
    (80, 'MsPlRef', 'microsoft public license'),
    (81, 'ArtisticRef', 'artistic license,? (version )?2'),
    (82, 'PerlRef', 'same terms as perl itself'),
    (83, 'PythonRef', 'python software foundation license'),
    (84, 'PostgresGrant', 'permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted'),
    (85, 'PhpRef', 'subject to version 3\.0?1? of the php license'),
    (86, 'EuplRef', 'european union public license'),
    (87, 'OflRef', 'sil open font license'),
    (88, 'OdblRef', 'open database license'),
    (89, 'CdlaRef', 'community data license agreement'),
    (90, 'RailRef', 'openrail(-m|\+\+)? license'),
    (91, 'Mit0Ref', 'mit no attribution license'),
    (92, 'Bsd3Ref', 'under the (terms of the )?(3-clause|new|modified|revised) bsd license'),
    (93, 'Bsd2Ref', 'under the (terms of the )?(2-clause|simplified) bsd license'),
    (94, 'Bsd4Advert', 'all advertising materials mentioning features or use of this software must display'),
    (95, 'BsdEndorse', 'the name of the author may not be used to endorse or promote'),
    (96, 'X11Names', 'except as contained in this notice, the names? of .* shall not be used in advertising'),
    (97, 'LiabilityMit', 'in no event shall the authors or copyright holders be liable for any claim, damages or other liability'),
    (98, 'LiabilityBsd', 'in no event shall the (copyright (holders?|owners?)|regents|authors?) or contributors be liable for any direct, indirect'),
    (99, 'Proprietary', '(confidential and proprietary|proprietary and confidential)'),
    (100, 'NoCopying', 'unauthorized copying of this file,? via any medium,? is strictly prohibited'),
    (101, 'InDomain', '(is|are|placed|released) (hereby )?(in|into) the public domain'),
    (102, 'LicenseFile', 'see the (accompanying )?license(\.txt|\.md)? file'),
    (103, 'PatentGrant', 'each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (copyright|patent) license'),
    (104, 'RightsReserved', 'all rights reserved'),
    (105, 'Copyright', '^(copyright|\(c\)|©)')
), rules(taken, licence) AS (VALUES
    ('BsdGrant BsdSource BsdBinary Bsd4Advert BsdNames BsdAsIs ', 'BSD-4-Clause'),
    ('BsdGrant BsdSource BsdBinary BsdEndorse BsdAsIs ', 'BSD-3-Clause'),
    ('BsdGrant BsdSource BsdBinary BsdNames BsdAsIs ', 'BSD-3-Clause'),
    ('BsdGrant BsdSource BsdBinary BsdAsIs ', 'BSD-2-Clause'),
    ('ApacheRef ApacheUse ApacheCopy ApacheAsIs ', 'Apache-2.0'),
    ('ApacheRef ApacheUse ', 'Apache-2.0'),
    ('ApacheRef ', 'Apache-2.0'),
    ('MitGrant MitNotice MitAsIs X11Names ', 'X11'),
    ('MitGrant MitNotice MitAsIs LiabilityMit X11Names ', 'X11'),
    ('MitRef MitGrant MitNotice MitAsIs ', 'MIT'),
    ('MitGrant MitNotice MitAsIs ', 'MIT'),
    ('MitRef ', 'MIT'),
    ('Gpl3Later GplHope GplCopy ', 'GPL-3.0-or-later'),
    ('Gpl3Later ', 'GPL-3.0-or-later'),
    ('Gpl2Later GplHope GplCopy ', 'GPL-2.0-or-later'),
    ('Gpl2Later ', 'GPL-2.0-or-later'),
    ('Gpl3Ref GplHope GplCopy ', 'GPL-3.0'),
    ('Gpl3Ref ', 'GPL-3.0'),
    ('Gpl2Ref GplHope GplCopy ', 'GPL-2.0'),
    ('Gpl2Ref ', 'GPL-2.0'),
    ('Lgpl3Later GplHope LgplCopy ', 'LGPL-3.0-or-later'),
    ('Lgpl3Later ', 'LGPL-3.0-or-later'),
    ('Lgpl21Later GplHope LgplCopy ', 'LGPL-2.1-or-later'),
    ('Lgpl21Later ', 'LGPL-2.1-or-later'),
    ('AgplLater GplHope AgplCopy ', 'AGPL-3.0-or-later'),
    ('AgplLater ', 'AGPL-3.0-or-later'),
    ('LgplRef ', 'LGPL'),
    ('AgplRef ', 'AGPL-3.0'),
    ('Mpl2Ref ', 'MPL-2.0'),
    ('CcByNc ', 'CC-BY-NC'),
    ('CcBySa ', 'CC-BY-SA'),
    ('CcBy ', 'CC-BY'),
    ('Cc0 ', 'CC0-1.0'),
    ('SpdxApache2 ', 'Apache-2.0'),
    ('SpdxMit ', 'MIT'),
    ('SpdxBsd3 ', 'BSD-3-Clause'),
    ('SpdxBsd2 ', 'BSD-2-Clause'),
    ('SpdxLgpl ', 'LGPL'),
    ('SpdxGpl3 ', 'GPL-3.0'),
    ('SpdxGpl2 ', 'GPL-2.0'),
    ('ApacheTitle ApacheTerms ', 'Apache-2.0'),
    ('ApacheTitle ', 'Apache-2.0'),
    ('Gpl3Title ', 'GPL-3.0'),
    ('Gpl2Title ', 'GPL-2.0'),
    ('GfdlRef ', 'GFDL'),
    ('IscGrant IscAsIs ', 'ISC'),
    ('IscGrant ', 'ISC'),
    ('ZlibAsIs ZlibGrant ZlibOrigin ZlibAltered ZlibNotice ', 'Zlib'),
    ('ZlibGrant ', 'Zlib'),
    ('BoostRef ', 'BSL-1.0'),
    ('BoostGrant ', 'BSL-1.0'),
    ('UnlicenseDomain UnlicenseAnyone ', 'Unlicense'),
    ('UnlicenseDomain ', 'Unlicense'),
    ('Epl2Ref ', 'EPL-2.0'),
    ('Epl1Ref ', 'EPL-1.0'),
    ('CddlRef ', 'CDDL'),
    ('MsPlRef ', 'MS-PL'),
    ('ArtisticRef ', 'Artistic-2.0'),
    ('PerlRef ', 'Perl'),
    ('PythonRef ', 'PSF'),
    ('PostgresGrant ', 'PostgreSQL'),
    ('PhpRef ', 'PHP-3.01'),
    ('EuplRef ', 'EUPL'),
    ('OflRef ', 'OFL'),
    ('OdblRef ', 'ODbL'),
    ('CdlaRef ', 'CDLA'),
    ('RailRef ', 'OpenRAIL'),
    ('Mit0Ref ', 'MIT-0'),
    ('Bsd3Ref ', 'BSD-3-Clause'),
    ('Bsd2Ref ', 'BSD-2-Clause'),
    ('CcByNcNd ', 'CC-BY-NC-ND'),
    ('CcByNcSa ', 'CC-BY-NC-SA'),
    ('CcByNd ', 'CC-BY-ND'),
    ('SpdxIsc ', 'ISC'),
    ('SpdxZlib ', 'Zlib'),
    ('SpdxBoost ', 'BSL-1.0'),
    ('SpdxUnlicense ', 'Unlicense'),
    ('SpdxEpl2 ', 'EPL-2.0'),
    ('SpdxEpl1 ', 'EPL-1.0'),
    ('SpdxMpl2 ', 'MPL-2.0'),
    ('SpdxAgpl3 ', 'AGPL-3.0'),
    ('SpdxCc0 ', 'CC0-1.0'),
    ('SpdxCcBySa ', 'CC-BY-SA'),
    ('SpdxCcBy ', 'CC-BY'),
    ('Spdx0Bsd ', '0BSD'),
    ('SpdxArtistic2 ', 'Artistic-2.0'),
    ('SpdxPostgres ', 'PostgreSQL'),
    ('SpdxMsPl ', 'MS-PL'),
    ('SpdxCddl ', 'CDDL'),
    ('SpdxWtfpl ', 'WTFPL'),
    ('SpdxOfl ', 'OFL'),
    ('Proprietary ', 'Proprietary'),
    ('NoCopying ', 'Proprietary'),
    ('InDomain ', 'Public domain'),
    ('Copyright RightsReserved ', 'All rights reserved'),
    ('RightsReserved ', 'All rights reserved')
), split AS (
    SELECT doc_id, string_split_regex(regexp_replace(text, '([.!?;])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+') AS parts
    FROM documents WHERE regexp_matches(text, '(?i)licen[cs]e|copyright|permission|warrant|redistribut|spdx|all rights reserved|public domain|free software|as is|contributors|misrepresented|altered|\bcompile|advertising|\bconfidential|\bperl\b|unauthorized|liable|reproduction')
), parts AS (
    SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS nr FROM split
), plain AS (
    SELECT doc_id, nr, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(lower(part),
        '^[\s/*#%;>\-"'']+|[\s*"'']+$', '', 'g'), '["''“”‘’`]', '', 'g'), 'licence', 'license'),
        '\b(19|20)[0-9][0-9]\b', '<year>', 'g'), '\s+', ' ', 'g') AS sentence
    FROM parts WHERE regexp_matches(part, '(?i)licen[cs]e|copyright|permission|warrant|redistribut|spdx|all rights reserved|public domain|free software|as is|contributors|misrepresented|altered|\bcompile|advertising|\bconfidential|\bperl\b|unauthorized|liable|reproduction')
), named AS (
    SELECT doc_id, nr, coalesce((SELECT arg_min(name, place) FROM known WHERE regexp_matches(sentence, pattern)),
        CASE WHEN regexp_matches(sentence, '\blicense[ds]?\b|\bcopyright\b|\bwarrant(y|ies)\b|\bredistribut') THEN 'Unknown' END) AS name
    FROM plain
), listed AS (
    SELECT doc_id, coalesce(string_agg(name, ' ' ORDER BY nr) FILTER (name <> 'Unknown'), '') AS identifiers,
        count(*) FILTER (name = 'Unknown') AS n_unknown
    FROM named GROUP BY doc_id
), taken AS (
    SELECT doc_id, regexp_extract_all(identifiers || ' ', '(?:BsdGrant BsdSource BsdBinary Bsd4Advert BsdNames BsdAsIs )|(?:BsdGrant BsdSource BsdBinary BsdEndorse BsdAsIs )|(?:BsdGrant BsdSource BsdBinary BsdNames BsdAsIs )|(?:BsdGrant BsdSource BsdBinary BsdAsIs )|(?:ApacheRef ApacheUse ApacheCopy ApacheAsIs )|(?:ApacheRef ApacheUse )|(?:ApacheRef )|(?:MitGrant MitNotice MitAsIs X11Names )|(?:MitGrant MitNotice MitAsIs LiabilityMit X11Names )|(?:MitRef MitGrant MitNotice MitAsIs )|(?:MitGrant MitNotice MitAsIs )|(?:MitRef )|(?:Gpl3Later GplHope GplCopy )|(?:Gpl3Later )|(?:Gpl2Later GplHope GplCopy )|(?:Gpl2Later )|(?:Gpl3Ref GplHope GplCopy )|(?:Gpl3Ref )|(?:Gpl2Ref GplHope GplCopy )|(?:Gpl2Ref )|(?:Lgpl3Later GplHope LgplCopy )|(?:Lgpl3Later )|(?:Lgpl21Later GplHope LgplCopy )|(?:Lgpl21Later )|(?:AgplLater GplHope AgplCopy )|(?:AgplLater )|(?:LgplRef )|(?:AgplRef )|(?:Mpl2Ref )|(?:CcByNc )|(?:CcBySa )|(?:CcBy )|(?:Cc0 )|(?:SpdxApache2 )|(?:SpdxMit )|(?:SpdxBsd3 )|(?:SpdxBsd2 )|(?:SpdxLgpl )|(?:SpdxGpl3 )|(?:SpdxGpl2 )|(?:ApacheTitle ApacheTerms )|(?:ApacheTitle )|(?:Gpl3Title )|(?:Gpl2Title )|(?:GfdlRef )|(?:IscGrant IscAsIs )|(?:IscGrant )|(?:ZlibAsIs ZlibGrant ZlibOrigin ZlibAltered ZlibNotice )|(?:ZlibGrant )|(?:BoostRef )|(?:BoostGrant )|(?:UnlicenseDomain UnlicenseAnyone )|(?:UnlicenseDomain )|(?:Epl2Ref )|(?:Epl1Ref )|(?:CddlRef )|(?:MsPlRef )|(?:ArtisticRef )|(?:PerlRef )|(?:PythonRef )|(?:PostgresGrant )|(?:PhpRef )|(?:EuplRef )|(?:OflRef )|(?:OdblRef )|(?:CdlaRef )|(?:RailRef )|(?:Mit0Ref )|(?:Bsd3Ref )|(?:Bsd2Ref )|(?:CcByNcNd )|(?:CcByNcSa )|(?:CcByNd )|(?:SpdxIsc )|(?:SpdxZlib )|(?:SpdxBoost )|(?:SpdxUnlicense )|(?:SpdxEpl2 )|(?:SpdxEpl1 )|(?:SpdxMpl2 )|(?:SpdxAgpl3 )|(?:SpdxCc0 )|(?:SpdxCcBySa )|(?:SpdxCcBy )|(?:Spdx0Bsd )|(?:SpdxArtistic2 )|(?:SpdxPostgres )|(?:SpdxMsPl )|(?:SpdxCddl )|(?:SpdxWtfpl )|(?:SpdxOfl )|(?:Proprietary )|(?:NoCopying )|(?:InDomain )|(?:Copyright RightsReserved )|(?:RightsReserved )') AS found FROM listed WHERE identifiers <> ''
), matched AS (
    SELECT doc_id, string_agg(licence, '|' ORDER BY nr) AS licences
    FROM (SELECT doc_id, unnest(found) AS one, generate_subscripts(found, 1) AS nr FROM taken)
    JOIN (SELECT DISTINCT taken AS one, licence FROM rules) USING (one) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(identifiers, '') AS identifiers, coalesce(licences, '') AS licences,
    coalesce(n_unknown, 0)::BIGINT AS n_unknown
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN matched USING (doc_id)
"""
