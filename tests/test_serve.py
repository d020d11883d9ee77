"""The HTTP service on a free port."""

import base64
import json
import threading
import urllib.error
import urllib.request

from lots import bar, photo

from orilla import serve
from orilla.sources import images


def test_requests(spark):
    s = serve.server(spark)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{s.server_port}"

    def ask(path, body=None):
        try:
            with urllib.request.urlopen(url + path, data=body, timeout=120) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()

    try:
        assert ask("/health")[0] == 200 and ask("/nothing")[0] == 404
        code, out = ask("/crop", images.png(bar(photo(), "bottom", 50)))
        assert code == 200 and int.from_bytes(out[16:20], "big") == 400 and int.from_bytes(out[20:24], "big") == 250
        clean = images.png(photo())
        code, out = ask("/crop/json", json.dumps({"image_base64": base64.b64encode(clean).decode()}).encode())
        assert code == 200 and json.loads(out)["status"] == "noop" and base64.b64decode(json.loads(out)["image_base64"]) == clean
        assert ask("/crop", b"\x89PNG junk")[0] == 422
        assert ask("/crop/json", b"{}")[0] == 400
    finally:
        s.shutdown()
