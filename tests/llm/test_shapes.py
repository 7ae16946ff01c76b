import random
import re
import textwrap

import pytest

from heddle.llm.shapes import list_pages, list_share

PROSE = ["The tests cover empty files, broken lines and repeated keys.", "In episode 7 the lead of the show meets an old classmate in the town.", "这一轮一共跑了47分7秒，比上一轮少了3分钟。", "请不要直接改生成物，改了也会在夜里被覆盖。"]
KEYS = ["鹿雨高清", "山海下载", "云灯在线"]
SPAM = {
    "tags": "\n".join("#" + k for k in KEYS * 8),
    "tags in a row": "".join("#" + k for k in KEYS * 8),
    "keywords": ",".join(KEYS * 8),
    "keywords by spaces": " ".join(KEYS * 8),
    "no separators": "墨月楼谷下载鼓雨楼谷下载狐榭楼谷下载鸥鹭楼谷下载雁剑楼谷下载",
    "lines": "\n".join(f"online pepi {w}" for w in "Myrivo Fraopt Tili Toti Gulnel Dalli Lipyx".split()),
    "numbered": "\n".join(f"{i}. free limo live martor !!!" for i in range(12)),
    "links": "\n".join(f"https://a{i}.test/play/x{i}" for i in range(9)),
    "pairs": " ".join(f"brand:RA{i} colour:RE{i}" for i in range(9)),
    "stuffed": "For cheap oni try live lox, because cheap oni means cheap oni. Looking for cheap oni? live lox is live lox, cheap oni too. For live lox try live lox, because live lox means cheap oni.",
    "stuffed zh": "想看云云直播就来云云直播，晨潮全集尽在云云直播。想看晨潮全集就来云云直播，云云直播尽在云云直播。晨潮全集推荐云云直播，更多云云直播请搜云云直播。",
}


@pytest.mark.parametrize("kind", SPAM)
def test_spam(kind):
    assert list_share(SPAM[kind]) > 0.5
    assert list_share(PROSE[0] + "\n" + SPAM[kind] * 4) > 0.5


@pytest.mark.parametrize("kind", SPAM)
def test_minor_share(kind):
    r = random.Random(3)
    word = lambda: "".join(r.choice(["ba", "ri", "to", "sel", "mun", "ka", "ve"]) for _ in range(3))
    prose = "\n".join(f"The {word()} of {word()} was {word()} by the {word()}, and it {word()} to {word()} at {word()}." for _ in range(60))
    assert list_share(prose) < 0.1
    assert list_share(prose + "\n" + SPAM[kind]) < 0.5


def test_ordinary_texts():
    for p in PROSE:
        assert list_share(p) == 0
    assert list_share("## Notes\n\n" + "\n".join("- " + p for p in PROSE)) < 0.3
    assert list_share("Mind that the notes of Sletobi are 2071\n>  days behind Garpyxba and that Kifyngre\n>  lacks row 6768. A line run by Varico") < 0.5
    for t in (None, "", " \n ", "…", "Title"):
        assert list_share(t) == 0


def test_operator(spark):
    rows = [(1, SPAM["tags"]), (2, PROSE[0]), (3, None), (None, SPAM["links"]), (1, SPAM["tags"]), (5, ",".join(KEYS * 20_000))]
    df = spark.createDataFrame([(*r, 0.1) for r in rows], "id long, text string, share double")
    assert sorted((r.id for r in list_pages(df, id="id", text="text").collect()), key=str) == [1, 1, 5, None]
    assert list_pages(df.limit(0), id="id", text="text").count() == 0


#: Ordinary prose; made up.
LANGUAGES = {
    "fr": "Le matin, la vieille ville s'éveille lentement et les premiers marchands installent leurs étals sur la place. On entend au loin la cloche de l'église, puis le bruit des volets que l'on ouvre. Personne ne se presse, car la journée sera longue et chaude. Les enfants traversent la rue en riant, leurs cahiers sous le bras. Plus tard, vers midi, tout le monde se retrouve à l'ombre des platanes pour parler du temps et des récoltes.",
    "es": "El tren llegó con dos horas de retraso y nadie en la estación parecía sorprendido. La mujer del abrigo rojo miraba el reloj, suspiraba y volvía a leer la misma carta. Cuando por fin se abrieron las puertas, una multitud bajó al andén con maletas, cajas y bicicletas. Entonces ella lo vio entre la gente y sonrió sin decir nada. Caminaron juntos hasta la salida mientras empezaba a llover sobre los tejados.",
    "ru": "Вечером над рекой поднялся туман, и противоположный берег исчез из виду. Старик долго сидел на скамейке, слушал, как плещется вода, и вспоминал молодость. Потом он встал, поправил шапку и медленно пошёл домой по узкой тропинке. Дома его ждала внучка, которая уже приготовила чай и накрыла на стол. Они говорили до поздней ночи о том, что случилось за этот длинный год.",
    "ar": "في صباح ذلك اليوم خرج الصيادون إلى البحر قبل شروق الشمس بساعة كاملة. كانت الريح هادئة والأمواج صغيرة، لذلك توقع الجميع رحلة سهلة. عاد القارب الأول عند الظهر محملا بالسمك، ففرح أهل القرية كثيرا. جلس الأطفال على الشاطئ يراقبون الرجال وهم يصلحون الشباك القديمة. وفي المساء اجتمعوا حول النار يروون قصص الأجداد حتى نام الصغار.",
    "ko": "어제 저녁에 비가 많이 내려서 우리는 집에 일찍 돌아왔다. 어머니는 부엌에서 따뜻한 국을 끓이고 계셨고 동생은 창가에서 책을 읽고 있었다. 나는 젖은 옷을 갈아입고 식탁에 앉아 하루 동안 있었던 일을 이야기했다. 밖에서는 바람이 점점 세게 불었지만 방 안은 아주 조용하고 편안했다. 밤이 깊어지자 모두 각자의 방으로 들어가 잠이 들었다.",
    "hi": "सुबह होते ही गाँव के लोग अपने खेतों की ओर चल पड़े। आसमान साफ था और हल्की ठंडी हवा चल रही थी। बच्चों ने स्कूल जाने से पहले अपनी दादी से एक पुरानी कहानी सुनी। दोपहर में सब लोग बरगद के पेड़ के नीचे बैठकर खाना खाते हैं। शाम को मंदिर की घंटी बजती है और पूरा गाँव शांत हो जाता है।",
    "th": "เมื่อเช้านี้ฝนตกหนักมากจนถนนหน้าบ้านมีน้ำท่วมสูงถึงเข่า คุณแม่จึงให้พวกเราอยู่บ้านและช่วยกันทำความสะอาดห้องครัว พี่ชายซ่อมหน้าต่างที่พังไปเมื่อคืนก่อน ส่วนฉันนั่งอ่านหนังสือให้น้องฟังจนเขาหลับไป ตอนบ่ายแดดออกแล้วเราจึงเดินไปตลาดเพื่อซื้อผักและปลาสด ตกเย็นทุกคนนั่งกินข้าวด้วยกันและพูดคุยถึงเรื่องราวในวันนั้นอย่างมีความสุข",
    "de": "Am Abend saß der Lehrer noch lange im leeren Klassenzimmer und korrigierte die Hefte der Schüler. Draußen fuhr eine Straßenbahn vorbei, deren Licht kurz über die Tafel huschte. Er dachte an den kommenden Frühling, an die Reise in die Berge und an seinen alten Freund. Dann packte er seine Tasche, löschte das Licht und schloss leise die Tür. Auf dem Heimweg begegnete ihm niemand außer einer grauen Katze.",
    "pt": "A biblioteca da cidade fica numa rua estreita, perto do mercado antigo. Todos os dias, um senhor de óculos abre as janelas e arruma os jornais sobre a mesa comprida. Os estudantes chegam depois das aulas e ficam até o sol se pôr. Às vezes alguém conta uma história em voz baixa, e os outros fecham os livros para ouvir. No inverno, o cheiro de café enche a sala inteira.",
    "ja": "昨日の夕方、駅前の小さな喫茶店で古い友人に会った。彼は十年前と少しも変わらず、静かに笑いながら窓の外を眺めていた。私たちは学生時代の思い出や、これから始めたい仕事について長い時間話し合った。外に出ると雨はもう上がっていて、濡れた道に街灯の光が映っていた。また来月ここで会おうと約束して、私は電車に乗った。",
    "vi": "Sáng nay trời nhiều mây nhưng không mưa, nên chúng tôi quyết định đi bộ lên đồi. Con đường nhỏ chạy giữa hai hàng thông, và tiếng chim hót vang khắp nơi. Lên đến đỉnh, cả nhóm ngồi nghỉ, uống nước và ngắm thung lũng bên dưới. Một cụ già đi ngang qua kể cho chúng tôi nghe chuyện ngôi chùa cổ. Buổi chiều mọi người trở về, ai cũng mệt nhưng rất vui.",
    "el": "Το πρωί ο ψαράς έβγαλε τη βάρκα από το λιμάνι και τράβηξε για τα ανοιχτά. Η θάλασσα ήταν ήρεμη, μόνο ένα ελαφρύ αεράκι φυσούσε από τον βορρά. Στο χωριό οι γυναίκες ετοίμαζαν το ψωμί και τα παιδιά έπαιζαν στην πλατεία. Όταν γύρισε το βράδυ, όλοι μαζεύτηκαν γύρω του για να δουν τι είχε πιάσει. Εκείνος χαμογέλασε και άρχισε να λέει την ιστορία του.",
    "he": "בבוקר יצאנו לטיול ארוך בהרים והשמש עוד לא זרחה. הדרך היתה תלולה, אבל כולם הלכו בשקט ובסבלנות. בצהריים עצרנו ליד מעיין קטן, אכלנו לחם וגבינה ונחנו מעט בצל העצים. אחר כך המשכנו לטפס עד שראינו את הים מרחוק. בערב חזרנו הביתה עייפים ושמחים וסיפרנו לסבתא על כל מה שראינו.",
    "zh": "傍晚时分，河边的小路上还有几个散步的人。卖花的老太太把剩下的菊花分给了放学的孩子，自己只留了一朵插在衣襟上。远处传来火车的汽笛声，惊起了芦苇丛里的一群水鸟。我站在桥头看了很久，想起小时候跟父亲来这里钓鱼的情景。天色慢慢暗下来，路灯一盏一盏地亮了。",
}
#: Keywords in scripts of their own.
KEYWORDS = {
    "th": ["ดูหนังฟรี", "ซีรีส์ใหม่", "บอลสด", "เพลงฮิต", "ดาวน์โหลดเกม"],
    "ru": ["фильм онлайн", "сериал бесплатно", "дешёвый тур", "ставки спорт"],
    "ar": ["تحميل مجاني", "افلام جديدة", "مسلسلات تركية", "بث مباشر"],
    "hi": ["मुफ्त फिल्म", "नया गाना", "लाइव क्रिकेट", "सस्ता मोबाइल"],
    "ko": ["무료 영화", "최신 드라마", "실시간 축구", "게임 다운"],
}


@pytest.mark.parametrize("lang", LANGUAGES)
def test_prose_of_any_language(lang):
    t = LANGUAGES[lang]
    sentences = [x for x in re.split(r"(?<=[.。।])\s*", t) if x]
    wrapped = "\n".join(textwrap.wrap(t, 60))
    for form in (t, "\n".join(sentences), "\n".join("- " + x for x in sentences), wrapped, "> " + wrapped.replace("\n", "\n> "), re.sub("[.,。，।،]", "", t), t.lower(), t.upper()):
        assert list_share(form) < 0.3


@pytest.mark.parametrize("lang", KEYWORDS)
def test_keywords_of_any_script(lang):
    r = random.Random(2)
    words = [r.choice(KEYWORDS[lang]) for _ in range(60)]
    for sep in (" ", ", ", "\n", "|", " #"):
        assert list_share(sep.join(words)) > 0.5
        assert list_share(LANGUAGES[lang] + "\n" + sep.join(words * 3)) > 0.5
    assert list_share("\n".join(f"{i}. {w}" for i, w in enumerate(words))) > 0.5


def test_many_different_short_lines_are_no_list():
    """Short lines of ever different shapes, as in a poem, don't add up to a few shapes."""
    r = random.Random(4)
    word = lambda: "".join(r.choice(["ba", "Ri", "to", "Sel", "7", "ka", "Ve"]) for _ in range(3))
    assert list_share("\n".join(" ".join(word() for _ in range(r.randrange(5, 9))) for _ in range(60))) < 0.5


def test_keywords_run_together():
    """Keywords glued end to start leave one word that comes again and again."""
    r = random.Random(5)
    word = lambda: "".join(r.choice(["ba", "ri", "to", "sel", "mun", "ka", "ve"]) for _ in range(2)).title()
    for n in (9, 12, 30, 200):
        assert list_share("".join(f"free tora {word()}" for _ in range(n))) > 0.5
