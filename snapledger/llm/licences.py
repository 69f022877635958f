"""Licence notices to look for. The wording of public licence notices, and the phrases each must contain."""

#: label, notice, phrases of which all must stand in a file that is given the label
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
     to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software""",
     ["permission is hereby granted free of charge"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Licensed under the MIT License", ["mit license"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
     required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
     BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied""", ["apache license version 2 0"]),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
     version""", ["terms of the gnu general public license"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ["gnu general public license"]),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
     Public License as published by the Free Software Foundation; either version 2.1 of the License""",
     ["gnu lesser general public license"]),
    ("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
     Public License as published by the Free Software Foundation""", ["gnu affero general public license"]),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
     following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
     conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice""",
     ["redistribution and use in source and binary forms"]),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
     distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/""", ["mozilla public license"]),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies""",
     ["permission to use copy modify and or distribute this software for any purpose"]),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution"]),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
     publish, use, compile, sell, or distribute this software""", ["free and unencumbered software released into the public domain"]),
]

#: phrase and label
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
