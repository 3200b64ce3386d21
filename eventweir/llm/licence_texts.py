"""Fixed values of the licence scan: names, opening words and SPDX identifiers of public licences.

Every template is (label, key phrase, text), in lower-case words as the scan sees them. The key phrase
stands in the text; a file has to have it for the template to be considered.
"""

from __future__ import annotations

# Bodies, the opening words of each licence or of the notice it asks for.
BODIES = (
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("agpl", "affero general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", "permission to use copy modify", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("epl", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at"),
    ("cddl", "common development and distribution license", "the contents of this file are subject to the terms of the common development and distribution license you may not use this file except in compliance with the license"),
    ("boost", "boost software license", "boost software license version 1 0 permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "provided as is without any express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("artistic", "artistic license", "the artistic license preamble the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("wtfpl", "what the fuck you want to public license", "do what the fuck you want to public license everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("ofl", "sil open font license", "this font software is licensed under the sil open font license version 1 1 this license is copied below and is also available with a faq at"),
    ("psf", "python software foundation license", "python software foundation license version 2 this license agreement is between the python software foundation and the individual or organization accessing and otherwise using this software in source or binary form and its associated documentation"),
    ("postgresql", "without a written agreement is hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("eupl", "european union public licence", "licensed under the eupl or as soon they will be approved by the european commission subsequent versions of the european union public licence you may not use this work except in compliance with the licence"),
    ("ms-pl", "microsoft public license", "microsoft public license this license governs use of the accompanying software if you use the software you accept this license if you do not accept the license do not use the software"),
    ("ncsa", "to deal with the software without restriction", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("php", "php license", "this source file is subject to version 3 01 of the php license that is bundled with this package in the file license and is available through the world wide web at"),
    ("w3c", "w3c software notice and license", "w3c software notice and license this work and any related files is being provided by the copyright holders under the following license by obtaining using and or copying this work you agree that you have read understood and will comply with the following terms and conditions"),
    ("gfdl", "free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version published by the free software foundation with no invariant sections no front cover texts and no back cover texts"),
    ("odbl", "open database license", "this database is made available under the open database license any rights in individual contents of the database are licensed under the database contents license"),
    ("cc0", "waived all copyright and related or neighboring rights", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work this work is published from"),
    ("cc-by", "creative commons attribution", "this work is licensed under the creative commons attribution 4 0 international license to view a copy of this license visit"),
    ("cc-by-sa", "creative commons attribution sharealike", "this work is licensed under the creative commons attribution sharealike 4 0 international license to view a copy of this license visit"),
    ("cc-by-nd", "creative commons attribution noderivatives", "this work is licensed under the creative commons attribution noderivatives 4 0 international license to view a copy of this license visit"),
    ("cc-by-nc", "creative commons attribution noncommercial", "this work is licensed under the creative commons attribution noncommercial 4 0 international license to view a copy of this license visit"),
    ("reserved", "all rights reserved", "copyright all rights reserved"),
)

# Names by which a file refers to a licence. The name is the key phrase and the text.
NAMES = (
    ("mit", "mit license"),
    ("mit", "permission is hereby granted free of charge"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
    ("gpl", "gnu gpl"),
    ("gpl", "gpl v2"),
    ("gpl", "gpl v3"),
    ("lgpl", "lesser general public license"),
    ("lgpl", "gnu lgpl"),
    ("agpl", "affero general public license"),
    ("agpl", "gnu agpl"),
    ("bsd", "bsd license"),
    ("isc", "isc license"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("cddl", "common development and distribution license"),
    ("boost", "boost software license"),
    ("zlib", "zlib license"),
    ("artistic", "artistic license"),
    ("ofl", "sil open font license"),
    ("psf", "python software foundation license"),
    ("postgresql", "postgresql license"),
    ("eupl", "european union public licence"),
    ("ms-pl", "microsoft public license"),
    ("php", "php license"),
    ("gfdl", "gnu free documentation license"),
    ("odbl", "open database license"),
    ("cc0", "cc0 1 0"),
    ("cc0", "creative commons zero"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-nd", "creative commons attribution noderivatives"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nc", "creative commons attribution non commercial"),
)

# Notices, the shorter forms in which a licence's opening words are met.
NOTICES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "apache license", "apache license 2 0"),
    ("gpl", "general public license", "licensed under the gnu general public license version 3"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license version 3"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
)

# Label and first words of its SPDX identifier, as after "SPDX-License-Identifier:".
SPDX = (
    ("mit", "mit"), ("apache", "apache"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("bsd", "bsd"), ("bsd", "0bsd"),
    ("isc", "isc"), ("mpl", "mpl"), ("unlicense", "unlicense"), ("epl", "epl"), ("cddl", "cddl"), ("boost", "bsl"), ("zlib", "zlib"),
    ("artistic", "artistic"), ("wtfpl", "wtfpl"), ("ofl", "ofl"), ("psf", "psf"), ("postgresql", "postgresql"), ("eupl", "eupl"),
    ("ms-pl", "ms pl"), ("ncsa", "ncsa"), ("php", "php"), ("w3c", "w3c"), ("gfdl", "gfdl"), ("odbl", "odbl"), ("cc0", "cc0"),
)

TEMPLATES = (
    *BODIES,
    *NOTICES,
    *[(label, name, name) for label, name in NAMES],
    *[(label, f"spdx license identifier {name}", f"spdx license identifier {name}") for label, name in SPDX],
)
