"""Licence templates in markup, plain phrases, and their labels.

Fixed values: the wordings are those of the public licences and of their usual notices.
Markup: `<<beginOptional>> ... <<endOptional>>` may be left out; `<<var;name="n";match="M">>` stands for
words that may be replaced, where M is `.{a,b}` (a to b words of any kind) or wordings parted by `|`.
"""

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_COPYRIGHT = '<<beginOptional>>Copyright <<var;name="holder";match=".{1,16}">><<endOptional>> '
_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
             'FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE <<var;name="who";match="AUTHORS OR COPYRIGHT HOLDERS|COPYRIGHT HOLDERS|AUTHORS">> '
             'BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH '
             'THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_REDISTRIBUTION = ('Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: '
                   '<<beginOptional>><<var;name="b1";match="1|a">><<endOptional>> Redistributions of source code must retain the above copyright notice, '
                   'this list of conditions and the following disclaimer. <<beginOptional>><<var;name="b2";match="2|b">><<endOptional>> '
                   'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation '
                   'and/or other materials provided with the distribution.')

# One label may have several templates: the licence itself and the notices by which works declare it.
TEMPLATES = [
    ("MIT", _COPYRIGHT + 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
     '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
     'sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
     'The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or '
     'substantial portions of the Software. ' + _WARRANTY),
    ("MIT", '<<var;name="act";match="Released|Licensed|Distributed|Available">> under the <<beginOptional>>terms of the<<endOptional>> MIT License'),
    ("ISC", _COPYRIGHT + 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, '
     'provided that the above copyright notice and this permission notice appear in all copies.'),
    ("BSD-3-Clause", _COPYRIGHT + _REDISTRIBUTION + ' <<beginOptional>><<var;name="b3";match="3|c">><<endOptional>> Neither the name of <<var;name="org";match=".{1,16}">> '
     'nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.'),
    ("BSD-2-Clause", _COPYRIGHT + _REDISTRIBUTION + ' THIS SOFTWARE IS PROVIDED BY <<var;name="who";match=".{1,16}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'),
    ("Apache-2.0", '<<var;name="act";match="Released|Licensed|Distributed|Available">> under the <<beginOptional>>terms of the<<endOptional>> Apache License, Version 2.0'),
    ("GPL-2.0", '<<beginOptional>>GNU<<endOptional>> General Public License<<beginOptional>>, version<<endOptional>> <<var;name="v";match="2|v2|2 0">>'),
    ("GPL-3.0", '<<var;name="work";match="This work is licensed|This program is licensed|Licensed|Released|Distributed|Available">> under the '
     '<<beginOptional>>terms of the<<endOptional>> GNU General Public License, <<beginOptional>>version<<endOptional>> <<var;name="v";match="3|v3|3 0">>'),
    ("GPL-3.0", '<<beginOptional>>This program is free software: <<endOptional>>you can redistribute it and/or modify it under the terms of the GNU General Public License '
     'as published by the Free Software Foundation, either version 3 of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version.'),
    ("LGPL", 'GNU <<var;name="kind";match="Lesser|Library">> General Public License'),
    ("MPL-2.0", 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
    ("MPL-2.0", '<<var;name="act";match="Released|Licensed|Distributed|Available">> under the <<beginOptional>>terms of the<<endOptional>> Mozilla Public License, <<beginOptional>>version<<endOptional>> 2.0'),
    ("CC-BY-4.0", 'Creative Commons Attribution 4.0 <<beginOptional>>International<<endOptional>> <<beginOptional>>Public<<endOptional>> License'),
    ("CC-BY-SA", 'Creative Commons Attribution<<beginOptional>>-<<endOptional>>ShareAlike <<var;name="v";match="2 0|2 5|3 0|4 0">> <<beginOptional>><<var;name="port";match="International|Unported">><<endOptional>> License'),
    ("CC0-1.0", 'CC0 1.0 Universal'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain.'),
]
