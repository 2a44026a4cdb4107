"""Wording of public licenses, with template markup. Fixed values."""

#: (label, words of the phrase).
PHRASES = (
    ("gpl", "GNU General Public License"),
    ("apache", "Apache License"),
    ("cc-by", "CC BY"),
    ("mit", "MIT License"),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next
paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_PERMISSIVE_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-8>> DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL <<var;words=1-8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution."""

_BSD_NAMES = """<<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-16>> nor the
names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY <<var;words=1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS
FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: (label, text). A template begins with two words of its own.
TEMPLATES = (
    # Notices.
    ("mit", "<<beginOptional>>This work is <<endOptional>>released under the <<beginOptional>>terms"
     " of the <<endOptional>>MIT License"),
    ("mit", "licensed under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("gpl-2.0", "licensed under the GNU General Public License, <<beginOptional>>either"
     " <<endOptional>>version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, <<beginOptional>>either"
     " <<endOptional>>version 3"),
    ("cc-by-4.0", "licensed under <<beginOptional>>the <<endOptional>>CC BY 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>>the <<endOptional>>CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>the <<endOptional>>CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
     " License"),
    # Headers of files.
    ("apache-2.0-header", """Licensed under the Apache License, Version 2.0 (the "License"); you may
not use this file except in compliance with the License. You may obtain a copy of the License at
<<var;words=0-12>> Unless required by applicable law or agreed to in writing, software distributed
under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and
limitations under the License."""),
    ("gpl-header", """<<beginOptional>>This program <<endOptional>>is free software<<beginOptional>>:
<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU
<<beginOptional>>Lesser <<endOptional>><<beginOptional>>Affero <<endOptional>>General Public License
as published by the Free Software Foundation<<beginOptional>>, either<<endOptional>> version
<<var;words=1-3>> of the License<<beginOptional>>, or (at your option) any later
version<<endOptional>>"""),
    # Whole texts.
    ("mit-text", _MIT_GRANT),
    ("isc-text", """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute
this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""" + _PERMISSIVE_WARRANTY),
    ("0bsd-text", """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted.
""" + _PERMISSIVE_WARRANTY),
    ("bsd-2-clause-text", f"{_BSD_CONDITIONS} {_BSD_WARRANTY}"),
    ("bsd-3-clause-text", f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("zlib-text", """This software is provided 'as-is', without any express or implied warranty. In no
event will <<var;words=1-8>> be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:
<<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented; you must
not claim that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not required.
<<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as such, and must
not be misrepresented as being the original software.
<<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any source
distribution."""),
    ("unlicense-text", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means."""),
)
