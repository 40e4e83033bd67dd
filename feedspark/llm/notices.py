"""Licence texts for the scan: words lower-cased, punctuation left out. A body is listed clause by clause."""

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Common words that are not indexed.
COMMON = frozenset("a an and any are as at be by for from has have if in is it its may no not of on or that the this to was with without you your".split())

#: Label, text as commonly written, phrase that must stand in the match (without common words at its ends).
TEMPLATES = (
    # short notices
    ("mit", "released under the mit license", "mit license"),
    ("mit", "licensed under the mit license", "mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsd-3-clause", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    ("bsd-2-clause", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "neighboring rights"),
    # MIT
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", "sublicense and or sell copies"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", "other dealings in the software"),
    # BSD
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions of source code must retain"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistributions in binary form must reproduce"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived"),
    # ISC
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "distribute this software for any purpose with or without fee"),
    # Apache
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "specific language governing permissions"),
    # GNU
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "free software foundation either version 2"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "free software foundation either version 3"),
    ("lgpl-2.1", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", "lesser general public license as published by the free software foundation"),
    ("agpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "affero general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", "gnu general public license for more details"),
    # Mozilla, Boost, zlib, Unlicense
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "mozilla public license v 2 0"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software", "person or organization obtaining"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "authors be held liable"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "must not be misrepresented"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released"),
)
