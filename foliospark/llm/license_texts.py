"""Texts of short public licences, and digests of longer ones, by SPDX identifier."""

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so"
)
_ISC_TAIL = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

KNOWN: list[tuple[str, str]] = [
    ("MIT", f"MIT License\n\nCopyright (c) <year> <holders>\n\n{_MIT_GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\nCopyright <year> <holders>\n\n{_MIT_GRANT}.\n\n{_WARRANTY}"),
    ("ISC", f"ISC License\n\nCopyright (c) <year> <holders>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_TAIL}"),
    ("0BSD", f"Copyright (C) <year> by <holders>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_TAIL}"),
    ("BSD-2-Clause", f"Copyright (c) <year> <holders>\n\n{_BSD_HEAD}{_BSD_TAIL}"),
    ("BSD-3-Clause", f"Copyright (c) <year> <holders>\n\n{_BSD_HEAD}{_BSD_NAMES}{_BSD_TAIL}"),
    ("Zlib", "zlib License\n\nCopyright (c) <year> <holders>\n\nThis software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0-notice", 'Copyright <year> <holders>\n\nLicensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
]

#: SHA-256 of the canonical form (``licenses.canonical``) of longer licences as they are published: the whole
#: text, and where it has an appendix also the text down to the end of the terms.
DIGESTS: list[tuple[str, str]] = [
("Apache-2.0", "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543"),
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.0", "9645df35bc8e107839fb024e61e6728ee32745a72194667211f31f7bad57b7d8"),
    ("LGPL-2.0", "5b76795361ffca92776bfb6f87f31cc8c230526d08f639d965de248bd171ca59"),
    ("LGPL-2.1", "a5875b4abd0df481e41a66665de9bea2d629872285f8f890c7ff03f4f87cb0ef"),
    ("LGPL-2.1", "e8fff5aab68f3784c88bdf6c7d677d555dbfc3274d7e0a03da4870604bf989ed"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]
