"""Wordings of public licences: texts, headers and notices, as fixed values."""

from __future__ import annotations

# Whole texts, file headers and lines. Related texts contain most of each other: the containment tells them apart.
TEXTS = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License '
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT."
    ),
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
        "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "
        'AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause third clause": (
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "GPL-2.0 header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.0 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Library General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This library is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Library General Public License for more details."
    ),
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
        "or (at your option) any later version. This library is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0 header": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy "
        "at http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "EPL-2.0 header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "WTFPL": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and "
        "changing it is allowed as long as the name is changed."
    ),
    "GNU licence text": (
        "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is "
        "not allowed."
    ),
    "OFL-1.1 header": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "CC0-1.0 notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work."
    ),
    "CC-BY-NC-4.0 long notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-ND-4.0 long notice": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ),
    "CC-BY-NC-SA-4.0 long notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License."
    ),
    "CC-BY-NC-ND-4.0 long notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License."
    ),
    "Public domain notice": "This work is released into the public domain.",
    "All rights reserved": "All rights reserved.",
}

# The names that notices call a licence by. A notice is "under the NAME" or "under NAME".
NAMES = {
    "MIT": ("MIT License", "MIT Licence", "X11 License", "Expat License"),
    "ISC": ("ISC License",),
    "BSD": ("BSD License", "BSD style license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0", "Apache 2 License"),
    "GPL": ("GNU General Public License", "GNU GPL", "GPL"),
    "GPL-2.0": (
        "GNU General Public License version 2", "GNU General Public License v2", "GNU General Public License v2.0",
        "GNU GPL version 2", "GNU GPL v2", "GPL version 2", "GPL v2", "GPLv2", "GPL-2.0",
    ),
    "GPL-3.0": (
        "GNU General Public License version 3", "GNU General Public License v3", "GNU General Public License v3.0",
        "GNU GPL version 3", "GNU GPL v3", "GPL version 3", "GPL v3", "GPLv3", "GPL-3.0",
    ),
    "LGPL": ("GNU Lesser General Public License", "GNU Library General Public License", "GNU LGPL", "LGPL"),
    "LGPL-2.1": ("GNU Lesser General Public License version 2.1", "LGPL version 2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License version 3", "LGPL version 3", "LGPL v3", "LGPLv3", "LGPL-3.0"),
    "AGPL": ("GNU Affero General Public License", "GNU AGPL", "AGPL"),
    "AGPL-3.0": ("GNU Affero General Public License version 3", "AGPL version 3", "AGPL v3", "AGPLv3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"),
    "EPL": ("Eclipse Public License",),
    "BSL-1.0": ("Boost Software License",),
    "Zlib": ("zlib License", "zlib/libpng License"),
    "Artistic": ("Artistic License",),
    "EUPL": ("European Union Public Licence", "EUPL"),
    "OFL-1.1": ("SIL Open Font License", "OFL"),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("WTFPL",),
    "CC0-1.0": ("CC0 1.0", "CC0 license", "Creative Commons Zero"),
    "CC-BY-4.0": ("CC BY 4.0", "CC BY 4.0 License", "Creative Commons Attribution 4.0 License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 License"),
    "CC-BY-3.0": ("CC BY 3.0", "Creative Commons Attribution 3.0 License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}

# Identifiers as in SPDX-License-Identifier lines.
IDENTIFIERS = (
    "MIT ISC 0BSD BSD-2-Clause BSD-3-Clause Apache-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 EPL-2.0 BSL-1.0 Zlib "
    "Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0"
).split()

TEMPLATES = (
    TEXTS
    | {f"{licence} notice: under {the}{name}": f"under {the}{name}" for licence, names in NAMES.items() for name in names for the in ("the ", "")}
    | {f"{licence} identifier": f"SPDX-License-Identifier: {licence}" for licence in IDENTIFIERS}
)
