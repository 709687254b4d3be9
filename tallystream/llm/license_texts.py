"""License templates as data: label, words that a match must hold, and the text in lower case without punctuation."""

# The wording of public licenses and of the notices that name them.
MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions")
MIT_NOTICE = "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
MIT_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
    "or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the software or the use or other dealings in the software")
BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met")
BSD_TERMS = (
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and "
    "the following disclaimer in the documentation and or other materials provided with the distribution")
BSD_WARRANTY = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services loss of use data or profits or business interruption however caused and on any theory of liability "
    "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use "
    "of this software even if advised of the possibility of such damage")
ISC_GRANT = (
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies")
ISC_WARRANTY = (
    "the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness in no event shall the author be liable for any special direct "
    "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in "
    "an action of contract negligence or other tortious action arising out of or in connection with the use or "
    "performance of this software")
APACHE_NOTICE = (
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
    "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license")
GPL_NOTICE = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version")
MPL_NOTICE = (
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
    "distributed with this file you can obtain one at http mozilla org mpl 2 0")

#: A short notice is known by the words that name its license, so these must be there; a long text by its wording.
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files"),
    ("mit", "", f"{MIT_GRANT} {MIT_NOTICE} {MIT_WARRANTY}"),
    ("apache-2.0", "apache 2", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache", APACHE_NOTICE),
    ("gpl-3.0", "gnu 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "gnu 3", GPL_NOTICE),
    ("bsd", "", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "", f"{BSD_HEAD} {BSD_TERMS} {BSD_WARRANTY}"),
    ("isc", "", ISC_GRANT),
    ("isc", "", f"{ISC_GRANT} {ISC_WARRANTY}"),
    ("mpl-2.0", "mozilla", MPL_NOTICE),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
)
