"""Licence notices, grants and passages of licence bodies, as published,
that the scan looks for.

Each entry: label, text. Labels are lower-case SPDX identifiers; a text is one
passage of the licence that files carry.
"""

TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                   "or implied. See the License for the specific language governing permissions and limitations "
                   "under the License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("gpl-3.0", "You should have received a copy of the GNU General Public License along with this program. If not, "
                "see https://www.gnu.org/licenses/."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
                 "the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written "
                     "permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    # Short notices as files word them, with and without the article.
    ("mit", "Released under MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Licensed under MIT License."),
    ("apache-2.0", "Licensed under Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License 2.0."),
    ("apache-2.0", "Released under the Apache License 2.0."),
    ("cc-by-4.0", "Licensed under the CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under the CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under the CC BY-NC 4.0."),
    ("gpl-3.0", "Licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "Licensed under the GNU General Public License, version 2."),
    # Passages of licence bodies.
    ("apache-2.0", "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor "
                   "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
                   "copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, "
                   "sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("apache-2.0", "Grant of Patent License. Subject to the terms and conditions of this License, each Contributor "
                   "hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable "
                   "(except as stated in this section) patent license to make, have made, use, offer to sell, sell, "
                   "import, and otherwise transfer the Work"),
    ("apache-2.0", "Disclaimer of Warranty. Unless required by applicable law or agreed to in writing, Licensor "
                   "provides the Work (and each Contributor provides its Contributions) on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied, including, without limitation, "
                   "any warranties or conditions of TITLE, NON-INFRINGEMENT, MERCHANTABILITY, or FITNESS FOR A "
                   "PARTICULAR PURPOSE."),
    ("gpl-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("gpl-3.0", "The licenses for most software and other practical works are designed to take away your freedom to "
                "share and change the works. By contrast, the GNU General Public License is intended to guarantee "
                "your freedom to share and change all versions of a program--to make sure it remains free software "
                "for all its users."),
    ("gpl-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By "
                "contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
                "free software--to make sure the software is free for all its users."),
    ("gpl-2.0", "You may copy and distribute verbatim copies of the Program's source code as you receive it, in any "
                "medium, provided that you conspicuously and appropriately publish on each copy an appropriate "
                "copyright notice and disclaimer of warranty"),
    ("gpl-3.0", "You may convey verbatim copies of the Program's source code as you receive it, in any medium, "
                "provided that you conspicuously and appropriately publish on each copy an appropriate copyright "
                "notice"),
    ("lgpl-2.1", "The licenses for most software are designed to take away your freedom to share and change it. By "
                 "contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change "
                 "free software--to make sure the software is free for all its users. This license, the Lesser General "
                 "Public License, applies to some specially designated software packages"),
    ("lgpl-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of "
                 "version 3 of the GNU General Public License, supplemented by the additional permissions listed "
                 "below."),
    ("agpl-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of "
                 "works, specifically designed to ensure cooperation with the community in the case of network server "
                 "software."),
    ("mpl-2.0", "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: under "
                "intellectual property rights (other than patent or trademark) Licensable by such Contributor to use, "
                "reproduce, make available, modify, display, perform, distribute, and otherwise exploit its "
                "Contributions"),
    ("mpl-2.0", "Covered Software is provided under this License on an \"as is\" basis, without warranty of any kind, "
                "either expressed, implied, or statutory, including, without limitation, warranties that the Covered "
                "Software is free of defects, merchantable, fit for a particular purpose or non-infringing."),
    ("bsd-3-clause", "Redistributions in binary form must reproduce the above copyright notice, this list of "
                     "conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution."),
    ("bsd-3-clause", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
                     "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                     "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                     "INTERRUPTION)"),
]

#: Phrases whose words, standing consecutively, give a base label.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
