"""DOCX packages from raw XML, independent of the library's own writer."""

import io
import zipfile

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(body, header=None, footer=None):
    parts = {"word/document.xml": f"<w:document {NS}><w:body>{body}</w:body></w:document>"}
    if header is not None:
        parts["word/header1.xml"] = f"<w:hdr {NS}>{header}</w:hdr>"
    if footer is not None:
        parts["word/footer1.xml"] = f"<w:ftr {NS}>{footer}</w:ftr>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, xml in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + xml)
    return out.getvalue()
