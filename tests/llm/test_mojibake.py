from tomeflow.llm import mojibake as M


def test_originals():
    for read, written, text in (("cp1252", "utf-8", "Schlüssel"), ("mac_roman", "utf-8", "préparer"), ("gbk", "utf-8", "测试台账"), ("cp1252", "gb18030", "过滤器重启"), ("cp950", "gb18030", "登记簿重启")):
        bad = text.encode(written).decode(read, "replace")
        assert text in M.originals(bad).values(), (read, written)
    twice = "Prüfung".encode().decode("cp1252").encode().decode("cp1252")
    assert "Prüfung" in M.originals(twice).values()
    assert M.originals("für") == {} and M.originals("测试台的检查") == {}


def test_rows(spark):
    good = ["Die Prüfung läuft über Nacht für alle Geräte.", "El técnico revisa el número en el sótano.", "测试台的台账由值班长检查，并写明原因。", "Пульт оператора стоит у северных ворот.", "見積書は三階の棚にあります。", "Η βαλβίδα ελέγχεται κάθε βράδυ."]
    rows = [(i, f"s{i % 6}", good[i % 6], "x") for i in range(120)]
    bad = {200: "Die PrÃ¼fung lÃ¤uft Ã¼ber Nacht", 201: "fÃ¼r alle", 202: "almac�n", 203: "²âÊÔÌ¨µÄÌ¨ÕËÓÉÖµ°à³¤¼ì²é"}
    rows += [(i, "s0", t, "x") for i, t in bad.items()] + [(300, None, None, "x"), (301, "s1", "", "x"), (302, "s1", "plain ascii", "x"), (303, None, good[0], "x")]
    df = spark.createDataFrame(rows, "chunk_id long, source string, text string, token string")
    states = spark.createDataFrame([("s0", "garbled"), (None, "garbled"), ("s1", None)], "rel_path string, status string")
    assert {r.chunk_id for r in M.garbled_rows(df, states).collect()} == set(bad)
    fixed = {r.chunk_id: (r.repaired, r.recovered) for r in M.repaired(df, states).collect()}
    assert fixed[200] == ("Die Prüfung läuft über Nacht", True) and fixed[201] == ("für alle", True) and fixed[203] == ("测试台的台账由值班长检查", True) and not fixed[202][1]
    assert M.garbled_rows(df.limit(0), states.limit(0)).count() == 0


def test_single_pairs():
    cyrillic = {"cp1251", "koi8_r"}
    for read, written in M.SINGLE_PAIRS:
        n = 0
        for text in ("Привет", "отчёт") if written in cyrillic else ("España", "président", "können", "März", "número", "señal"):
            if (bad := text.encode(written).decode(read, "replace")) != text and "�" not in bad:
                n += 1
                assert text in M.originals(bad).values(), (read, written, text)
        assert n, (read, written)


def _model():
    texts = ["Die Prüfung läuft über Nacht für alle Geräte, und können die Größe der Lösung im März prüfen.", "El técnico revisa el número en el sótano de España, señal número aquí.", "Le président doit préparer la grève, été naïve.", "测试台的台账由值班长检查，并写明原因。过滤器重启登记簿", "Привет отчёт", "見積書は登記簿", "점검", "25 °C"]
    return M.Model(dict(M._counted((t, 20.0) for x in texts for t in x.split())))


def test_likelihood_keeps_what_was_garbled():
    """No token that a chain has garbled is out of the question, whatever its characters; long correct text is."""
    model = _model()
    for read, written in (*M.SINGLE_PAIRS, *M.MULTI_PAIRS, *((r, "utf-8") for r in (*M.SINGLE_BYTE, *M.MULTI_BYTE))):
        for text in ("España", "président", "März", "Привет", "过滤器重启", "登記簿", "見積書", "점검", "Lösung", "25°C"):
            bad = text.encode(written, "ignore").decode(read, "replace")
            if text in M.originals(bad).values():
                assert text in [x[1] for x in M.likely(bad, model)], (read, written, text)
    for bad, text in (("prÈparer", "préparer"), ("naÔve", "naïve"), ("prŽparer", "préparer"), ("ŽtŽ", "été"), ("L÷sung", "Lösung"), ("gr÷▀e", "größe"), ("L”sung", "Lösung"), ("掳C", "°C")):
        assert max(M.likely(bad, model), key=lambda x: x[2])[1] == text, bad
    for token in ("烫烫烫", "屯屯屯屯", "锟斤拷", "x�y"):
        assert ("lost", token) in [x[:2] for x in M.likely(token, model)]
    assert not M.likely("测试台的台账由值班长检查并写明原因", model) and not M.likely("für", model) and not M.likely("plain", model)


def test_score_stops_early():
    model = _model()
    for text in ("für", "测试台的台账", "", "a"):
        assert abs(model.score(text) - model.score(text, -1e9)) < 1e-9
    assert model.score("ţţţţţţţţ", -10.0) < -10.0 and model.score("ţţţţţţţţ", -10.0) >= model.score("ţţţţţţţţ")


def test_pools_and_kinds(spark):
    """A garbled source tells about its weak tokens; the same token elsewhere may be correct. A pool with most of the rows gives the same."""
    rows = [(i, "s0", "doc", "Die PrÃ¼fung lÃ¤uft Ã¼ber Nacht") for i in range(30)] + [(i, f"s{i % 7 + 1}", "DOC", "Die Prüfung läuft über Nacht") for i in range(30, 400)]
    df = spark.createDataFrame(rows, "chunk_id long, source string, doc_type string, text string")
    states = spark.createDataFrame([("s0", "garbled")], "rel_path string, status string")
    assert {r.chunk_id for r in M.garbled_rows(df, states).collect()} == set(range(30))
