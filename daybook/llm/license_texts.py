"""Standard headers, SPDX tags and full texts of public licenses (operator 1)."""

from __future__ import annotations

from functools import cache
from importlib import resources

_GNU = (
    "{it} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation, either version {v} of the License, or (at your option) any later version. "
    "{it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_PROGRAM, _LIBRARY = "This program", "This library"
HEADERS = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-2.0", _GNU.format(it=_PROGRAM, name="General Public License", v="2")),
    ("GPL-3.0", _GNU.format(it=_PROGRAM, name="General Public License", v="3")),
    ("LGPL-2.1", _GNU.format(it=_LIBRARY, name="Lesser General Public License", v="2.1")),
    ("LGPL-3.0", _GNU.format(it=_LIBRARY, name="Lesser General Public License", v="3")),
    ("AGPL-3.0", _GNU.format(it=_PROGRAM, name="Affero General Public License", v="3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
)
# Short forms as people write them; under five words they must stand word for word.
SHORT = (
    ("Apache-2.0", "Licensed under Apache 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("BSD", "BSD licensed"),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2"),
    ("GPL-2.0", "Licensed under GPL-2.0"),
    ("GPL-3.0", "Licensed under GPL-3.0"),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Licensed under MIT"),
    ("MIT", "MIT licensed"),
    ("Unlicense", "Released under the Unlicense."),
)
_GNU_IDS = ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
SPDX_IDS = {
    **{
        x: x
        for x in (
            "0BSD AFL-3.0 Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC0-1.0 CC-BY-3.0 "
            "CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CDDL-1.0 CPL-1.0 "
            "EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3 GPL-1.0 ISC MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA ODbL-1.0 OFL-1.1 OpenSSL "
            "PostgreSQL PSF-2.0 Python-2.0 Unlicense UPL-1.0 Vim W3C WTFPL Zlib ZPL-2.1"
        ).split()
    },
    **{x + end: x for x in _GNU_IDS for end in ("", "-only", "-or-later")},
}
TAG = "SPDX-License-Identifier"


@cache
def texts() -> tuple[tuple[str, str], ...]:
    """(license, text) of the headers, the short forms, the tags and the full texts, read on the driver."""
    full = [
        (f.name.removesuffix(".txt"), f.read_text(encoding="utf-8"))
        for f in resources.files("daybook.llm").joinpath("licenses").iterdir()
        if f.name.endswith(".txt")
    ]
    tags = [(name, f"{TAG}: {x}") for x, name in SPDX_IDS.items()]
    return (*HEADERS, *SHORT, *tags, *sorted(full))
