"""Which language a text is in, by a linear classifier on hashed character n-grams of words.

Every language starts from the same short text, written here; texts of the data that it tells apart with a wide margin are
learnt from in turn, so names and subjects of the data count for the language that they are mostly used in. A word's
weights are the sum of those of its n-grams, so a text costs a look-up for each of its words.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np

BUCKETS = 1 << 17
#: Share of the average language in each language's n-grams: an n-gram that a language lacks costs log(BACKGROUND) at most.
BACKGROUND = 0.1
WORD = re.compile(r"[^\W_]+")

#: One text in each language, to start from. Danish and Norwegian count as one, so do Czech and Slovak, Malay and Indonesian.
SEEDS = {
    "en": "I don't know what you mean, but we can talk about it tomorrow. My sister was here yesterday and she wanted to see you. Why did they not come with us? The children are playing in the garden because the weather is very good today. He has been working at the office for three years. If you have time, please call me after dinner. There is nothing left in the house, so I will go to the shop. Thank you very much, that was a beautiful evening. Where is the old man who lives near the river? It would be better to wait until everyone is here. I think their friends should have told him which one it is. How are you doing, is everything all right with your mother? We were just about to leave when his phone rang.",
    "de": "Ich weiß nicht, was du meinst, aber wir können morgen darüber reden. Meine Schwester war gestern hier und wollte dich sehen. Warum sind sie nicht mit uns gekommen? Die Kinder spielen im Garten, weil das Wetter heute sehr gut ist. Er arbeitet seit drei Jahren im Büro. Wenn du Zeit hast, ruf mich bitte nach dem Abendessen an. Es ist nichts mehr im Haus, also gehe ich in den Laden. Vielen Dank, das war ein schöner Abend. Wo ist der alte Mann, der am Fluss wohnt? Es wäre besser zu warten, bis alle da sind. Ich glaube, ihre Freunde hätten ihm sagen sollen, welches es ist. Wie geht es dir, ist mit deiner Mutter alles in Ordnung? Wir wollten gerade gehen, als sein Telefon klingelte.",
    "fr": "Je ne sais pas ce que tu veux dire, mais nous pouvons en parler demain. Ma sœur était ici hier et elle voulait te voir. Pourquoi ne sont-ils pas venus avec nous ? Les enfants jouent dans le jardin parce qu'il fait très beau aujourd'hui. Il travaille au bureau depuis trois ans. Si tu as le temps, appelle-moi après le dîner, s'il te plaît. Il ne reste rien à la maison, alors je vais aller au magasin. Merci beaucoup, c'était une belle soirée. Où est le vieil homme qui habite près de la rivière ? Il vaudrait mieux attendre que tout le monde soit là. Je crois que leurs amis auraient dû lui dire lequel c'est. Comment vas-tu, est-ce que tout va bien avec ta mère ? Nous allions partir quand son téléphone a sonné.",
    "es": "No sé qué quieres decir, pero podemos hablar de eso mañana. Mi hermana estuvo aquí ayer y quería verte. ¿Por qué no vinieron con nosotros? Los niños juegan en el jardín porque hoy hace muy buen tiempo. Él trabaja en la oficina desde hace tres años. Si tienes tiempo, llámame después de la cena, por favor. No queda nada en la casa, así que iré a la tienda. Muchas gracias, fue una noche muy bonita. ¿Dónde está el viejo que vive cerca del río? Sería mejor esperar hasta que todos estén aquí. Creo que sus amigos deberían haberle dicho cuál es. ¿Cómo estás, está todo bien con tu madre? Estábamos a punto de salir cuando sonó su teléfono.",
    "it": "Non so cosa vuoi dire, ma possiamo parlarne domani. Mia sorella era qui ieri e voleva vederti. Perché non sono venuti con noi? I bambini giocano nel giardino perché oggi il tempo è molto bello. Lui lavora in ufficio da tre anni. Se hai tempo, chiamami dopo cena, per favore. Non è rimasto niente in casa, quindi andrò al negozio. Grazie mille, è stata una bella serata. Dov'è il vecchio che abita vicino al fiume? Sarebbe meglio aspettare finché ci sono tutti. Credo che i loro amici avrebbero dovuto dirgli qual è. Come stai, va tutto bene con tua madre? Stavamo per uscire quando gli è suonato il telefono. Anche questa volta gli altri sono più lontani della stazione.",
    "pt": "Não sei o que você quer dizer, mas podemos falar sobre isso amanhã. A minha irmã esteve aqui ontem e queria ver-te. Por que eles não vieram conosco? As crianças brincam no jardim porque hoje o tempo está muito bom. Ele trabalha no escritório há três anos. Se tiver tempo, ligue-me depois do jantar, por favor. Não sobrou nada em casa, então vou à loja. Muito obrigado, foi uma noite linda. Onde está o velho que mora perto do rio? Seria melhor esperar até que todos estejam aqui. Acho que os amigos deles deviam ter dito qual é. Como vai você, está tudo bem com a sua mãe? Estávamos quase saindo quando o telefone dele tocou. Também não sabemos se ela já comprou as coisas.",
    "nl": "Ik weet niet wat je bedoelt, maar we kunnen er morgen over praten. Mijn zus was hier gisteren en ze wilde je zien. Waarom zijn ze niet met ons meegekomen? De kinderen spelen in de tuin omdat het weer vandaag heel goed is. Hij werkt al drie jaar op kantoor. Als je tijd hebt, bel me dan na het eten. Er is niets meer in huis, dus ik ga naar de winkel. Heel erg bedankt, dat was een mooie avond. Waar is de oude man die bij de rivier woont? Het zou beter zijn om te wachten tot iedereen er is. Ik denk dat hun vrienden hem hadden moeten zeggen welke het is. Hoe gaat het met jou, is alles goed met je moeder? We wilden net vertrekken toen zijn telefoon ging.",
    "sv": "Jag vet inte vad du menar, men vi kan prata om det i morgon. Min syster var här i går och hon ville träffa dig. Varför kom de inte med oss? Barnen leker i trädgården eftersom vädret är mycket bra i dag. Han har arbetat på kontoret i tre år. Om du har tid, ring mig efter middagen. Det finns ingenting kvar i huset, så jag går till affären. Tack så mycket, det var en vacker kväll. Var är den gamle mannen som bor nära floden? Det vore bättre att vänta tills alla är här. Jag tror att deras vänner borde ha sagt till honom vilken det är. Hur mår du, är allt bra med din mamma? Vi skulle just gå när hans telefon ringde.",
    "da": "Jeg ved ikke, hvad du mener, men vi kan tale om det i morgen. Min søster var her i går, og hun ville gerne se dig. Hvorfor kom de ikke med os? Børnene leger i haven, fordi vejret er meget godt i dag. Han har arbejdet på kontoret i tre år. Hvis du har tid, så ring til mig efter aftensmaden. Der er ikke noget tilbage i huset, så jeg går hen til butikken. Mange tak, det var en smuk aften. Hvor er den gamle mand, som bor ved floden? Jeg vet ikke hva du mener, men vi kan snakke om det. Søsteren min var her og ville se deg. Hvorfor ble de ikke med oss? Hun har vært på jobb etter middag, og noen av barna leker ute nå. Takk skal du ha, det var en fin kveld.",
    "fi": "En tiedä, mitä tarkoitat, mutta voimme puhua siitä huomenna. Siskoni oli täällä eilen ja hän halusi nähdä sinut. Miksi he eivät tulleet meidän kanssamme? Lapset leikkivät puutarhassa, koska sää on tänään hyvin kaunis. Hän on työskennellyt toimistossa kolme vuotta. Jos sinulla on aikaa, soita minulle illallisen jälkeen. Talossa ei ole mitään jäljellä, joten menen kauppaan. Kiitos paljon, se oli kaunis ilta. Missä on vanha mies, joka asuu joen lähellä? Olisi parempi odottaa, kunnes kaikki ovat täällä. Luulen, että heidän ystäviensä olisi pitänyt kertoa hänelle. Miten voit, onko äidilläsi kaikki hyvin?",
    "pl": "Nie wiem, co masz na myśli, ale możemy o tym porozmawiać jutro. Moja siostra była tutaj wczoraj i chciała się z tobą zobaczyć. Dlaczego oni nie przyszli z nami? Dzieci bawią się w ogrodzie, bo dzisiaj jest bardzo ładna pogoda. On pracuje w biurze od trzech lat. Jeśli masz czas, zadzwoń do mnie po kolacji. Nic już nie zostało w domu, więc pójdę do sklepu. Dziękuję bardzo, to był piękny wieczór. Gdzie jest ten stary człowiek, który mieszka przy rzece? Lepiej byłoby poczekać, aż wszyscy tu będą. Myślę, że ich przyjaciele powinni mu byli powiedzieć, który to jest. Jak się masz, czy wszystko w porządku z twoją mamą?",
    "cs": "Nevím, co tím myslíš, ale můžeme o tom mluvit zítra. Moje sestra tady byla včera a chtěla tě vidět. Proč s námi nepřišli? Děti si hrají na zahradě, protože je dnes velmi hezké počasí. Pracuje v kanceláři už tři roky. Jestli máš čas, zavolej mi prosím po večeři. V domě už nic nezbylo, takže půjdu do obchodu. Děkuji moc, byl to krásný večer. Kde je ten starý muž, který bydlí u řeky? Bylo by lepší počkat, až budou všichni tady. Neviem, čo tým myslíš, ale môžeme sa o tom porozprávať. Ako sa máš, je všetko v poriadku s tvojou mamou? Prečo neprišli, keď sme ich čakali? Myslím, že jejich přátelé mu měli říct, který to je.",
    "hu": "Nem tudom, mire gondolsz, de holnap beszélhetünk róla. A nővérem tegnap itt volt, és látni akart téged. Miért nem jöttek velünk? A gyerekek a kertben játszanak, mert ma nagyon jó az idő. Ő három éve dolgozik az irodában. Ha van időd, kérlek, hívj fel vacsora után. Nem maradt semmi a házban, ezért elmegyek a boltba. Nagyon köszönöm, ez egy szép este volt. Hol van az öreg ember, aki a folyó mellett lakik? Jobb lenne várni, amíg mindenki itt lesz. Azt hiszem, a barátaiknak meg kellett volna mondaniuk neki, melyik az. Hogy vagy, minden rendben van az anyáddal?",
    "ro": "Nu știu ce vrei să spui, dar putem vorbi despre asta mâine. Sora mea a fost aici ieri și voia să te vadă. De ce nu au venit cu noi? Copiii se joacă în grădină pentru că astăzi vremea este foarte bună. El lucrează la birou de trei ani. Dacă ai timp, te rog să mă suni după cină. Nu a mai rămas nimic în casă, așa că mă duc la magazin. Mulțumesc mult, a fost o seară frumoasă. Unde este bătrânul care locuiește lângă râu? Ar fi mai bine să așteptăm până când toată lumea este aici. Cred că prietenii lor ar fi trebuit să îi spună care este. Ce mai faci, este totul bine cu mama ta?",
    "tr": "Ne demek istediğini bilmiyorum ama bunu yarın konuşabiliriz. Kız kardeşim dün buradaydı ve seni görmek istiyordu. Neden bizimle gelmediler? Çocuklar bahçede oynuyor çünkü bugün hava çok güzel. O üç yıldır ofiste çalışıyor. Vaktin varsa lütfen akşam yemeğinden sonra beni ara. Evde hiçbir şey kalmadı, bu yüzden dükkana gideceğim. Çok teşekkür ederim, güzel bir akşamdı. Nehrin yanında yaşayan yaşlı adam nerede? Herkes gelene kadar beklemek daha iyi olur. Bence arkadaşları ona hangisi olduğunu söylemeliydi. Nasılsın, annenle her şey yolunda mı? Tam çıkmak üzereydik ki telefonu çaldı.",
    "id": "Saya tidak tahu apa maksudmu, tetapi kita bisa membicarakannya besok. Kakak perempuan saya ada di sini kemarin dan dia ingin bertemu denganmu. Mengapa mereka tidak datang bersama kami? Anak-anak bermain di taman karena cuaca hari ini sangat bagus. Dia sudah bekerja di kantor selama tiga tahun. Kalau kamu punya waktu, tolong telepon saya setelah makan malam. Tidak ada yang tersisa di rumah, jadi saya akan pergi ke toko. Terima kasih banyak, itu malam yang indah. Di mana orang tua yang tinggal dekat sungai? Lebih baik menunggu sampai semua orang ada di sini. Apa kabar, apakah semuanya baik dengan ibumu?",
    "vi": "Tôi không biết bạn muốn nói gì, nhưng chúng ta có thể nói về điều đó ngày mai. Chị tôi đã ở đây hôm qua và chị ấy muốn gặp bạn. Tại sao họ không đến với chúng tôi? Bọn trẻ đang chơi trong vườn vì hôm nay thời tiết rất đẹp. Anh ấy làm việc ở văn phòng ba năm rồi. Nếu bạn có thời gian, hãy gọi cho tôi sau bữa tối. Trong nhà không còn gì cả, nên tôi sẽ đi ra cửa hàng. Cảm ơn rất nhiều, đó là một buổi tối tuyệt vời. Ông già sống gần sông đâu rồi? Tốt hơn là chờ cho đến khi mọi người có mặt. Bạn có khỏe không, mẹ bạn có ổn không?",
    "ru": "Я не знаю, что ты имеешь в виду, но мы можем поговорить об этом завтра. Моя сестра была здесь вчера и хотела тебя увидеть. Почему они не пришли с нами? Дети играют в саду, потому что сегодня очень хорошая погода. Он работает в офисе уже три года. Если у тебя есть время, позвони мне, пожалуйста, после ужина. В доме ничего не осталось, поэтому я пойду в магазин. Большое спасибо, это был прекрасный вечер. Где тот старик, который живёт у реки? Было бы лучше подождать, пока все соберутся. Я думаю, что их друзья должны были сказать ему, какой это. Как твои дела, всё ли хорошо с твоей мамой?",
    "uk": "Я не знаю, що ти маєш на увазі, але ми можемо поговорити про це завтра. Моя сестра була тут учора і хотіла тебе побачити. Чому вони не прийшли з нами? Діти граються в саду, бо сьогодні дуже гарна погода. Він працює в офісі вже три роки. Якщо в тебе є час, зателефонуй мені, будь ласка, після вечері. У будинку нічого не залишилося, тому я піду до крамниці. Щиро дякую, це був чудовий вечір. Де той старий чоловік, який живе біля річки? Було б краще почекати, поки всі зберуться. Як твої справи, чи все гаразд із твоєю мамою?",
    "bg": "Не знам какво искаш да кажеш, но можем да говорим за това утре. Сестра ми беше тук вчера и искаше да те види. Защо не дойдоха с нас? Децата играят в градината, защото днес времето е много хубаво. Той работи в офиса от три години. Ако имаш време, моля те, обади ми се след вечеря. В къщата не е останало нищо, затова ще отида до магазина. Много благодаря, това беше прекрасна вечер. Къде е старият човек, който живее близо до реката? По-добре би било да изчакаме, докато всички са тук. Как си, всичко наред ли е с майка ти?",
    "el": "Δεν ξέρω τι εννοείς, αλλά μπορούμε να μιλήσουμε γι' αυτό αύριο. Η αδερφή μου ήταν εδώ χθες και ήθελε να σε δει. Γιατί δεν ήρθαν μαζί μας; Τα παιδιά παίζουν στον κήπο, επειδή σήμερα ο καιρός είναι πολύ καλός. Δουλεύει στο γραφείο εδώ και τρία χρόνια. Αν έχεις χρόνο, πάρε με τηλέφωνο μετά το δείπνο. Ευχαριστώ πολύ, ήταν ένα όμορφο βράδυ. Πού είναι ο γέρος που μένει κοντά στο ποτάμι;",
    "ar": "لا أعرف ماذا تقصد، لكن يمكننا أن نتحدث عن ذلك غدا. كانت أختي هنا أمس وأرادت أن تراك. لماذا لم يأتوا معنا؟ الأطفال يلعبون في الحديقة لأن الطقس جميل جدا اليوم. هو يعمل في المكتب منذ ثلاث سنوات. إذا كان لديك وقت، اتصل بي بعد العشاء من فضلك. شكرا جزيلا، كانت أمسية جميلة. أين الرجل العجوز الذي يسكن قرب النهر؟",
    "fa": "نمی‌دانم منظورت چیست، اما می‌توانیم فردا درباره آن صحبت کنیم. خواهرم دیروز اینجا بود و می‌خواست تو را ببیند. چرا آنها با ما نیامدند؟ بچه‌ها در باغ بازی می‌کنند چون امروز هوا خیلی خوب است. او سه سال است که در دفتر کار می‌کند. اگر وقت داری، لطفا بعد از شام به من زنگ بزن. خیلی ممنون، شب زیبایی بود.",
    "he": "אני לא יודע למה אתה מתכוון, אבל אנחנו יכולים לדבר על זה מחר. אחותי הייתה כאן אתמול והיא רצתה לראות אותך. למה הם לא באו איתנו? הילדים משחקים בגן כי מזג האוויר היום טוב מאוד. הוא עובד במשרד כבר שלוש שנים. אם יש לך זמן, תתקשר אליי אחרי ארוחת הערב. תודה רבה, זה היה ערב יפה.",
    "hi": "मुझे नहीं पता कि तुम क्या कहना चाहते हो, लेकिन हम कल इसके बारे में बात कर सकते हैं। मेरी बहन कल यहाँ थी और वह तुमसे मिलना चाहती थी। वे हमारे साथ क्यों नहीं आए? बच्चे बगीचे में खेल रहे हैं क्योंकि आज मौसम बहुत अच्छा है। वह तीन साल से दफ्तर में काम कर रहा है। बहुत धन्यवाद, वह एक सुंदर शाम थी।",
    "ja": "あなたが何を言いたいのか分かりませんが、明日それについて話すことができます。昨日、姉がここに来て、あなたに会いたがっていました。どうして彼らは私たちと一緒に来なかったのですか。今日はとても天気がいいので、子供たちは庭で遊んでいます。彼は三年前から会社で働いています。時間があれば、夕食の後に電話してください。家には何も残っていないので、店に行きます。どうもありがとう、とても素敵な夜でした。",
    "zh": "我不知道你是什么意思，但是我们明天可以谈谈这件事。我姐姐昨天在这里，她想见你。他们为什么没有和我们一起来？孩子们在花园里玩，因为今天天气很好。他在办公室工作了三年。如果你有时间，请在晚饭后给我打电话。家里什么都没有了，所以我要去商店。非常感谢，那是一个美好的夜晚。住在河边的那位老人在哪里？最好等到大家都到了。你最近怎么样，你妈妈一切都好吗？",
    "ko": "무슨 말인지 모르겠지만 내일 이야기할 수 있어요. 언니가 어제 여기 왔었고 당신을 만나고 싶어 했어요. 왜 그들은 우리와 함께 오지 않았나요? 오늘은 날씨가 아주 좋아서 아이들이 정원에서 놀고 있어요. 그는 삼 년 동안 사무실에서 일했어요. 시간이 있으면 저녁 식사 후에 전화해 주세요. 정말 고마워요, 아름다운 저녁이었어요.",
    "th": "ฉันไม่รู้ว่าคุณหมายถึงอะไร แต่เราคุยเรื่องนี้กันพรุ่งนี้ได้ พี่สาวของฉันอยู่ที่นี่เมื่อวานนี้และเธออยากเจอคุณ ทำไมพวกเขาไม่มากับเรา เด็กๆ กำลังเล่นอยู่ในสวนเพราะวันนี้อากาศดีมาก ขอบคุณมาก มันเป็นค่ำคืนที่สวยงาม",
}
LANGUAGES = tuple(SEEDS)


def ngrams(word: str) -> list[int]:
    """Buckets of a word's n-grams of one to four characters, of the word itself, and of the scripts of its letters."""
    w = f"^{word[:64]}$"
    parts = {f"={word}", *(w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1))} - {"^", "$"}
    parts |= {"~" + unicodedata.name(c, "?").split(" ")[0] for c in set(word) if ord(c) > 0x24F}
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class Languages:
    """The classifier: a matrix of weights, hashed n-grams by languages, and the sums of words that were met."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self._words: dict[str, int] = {}
        self._vectors = np.zeros((1024, len(LANGUAGES)), np.float32)

    def __reduce__(self):
        return Languages, (self.weights,)

    def word_ids(self, words: list[str]) -> list[int]:
        """Where the sum of each word's weights is in ``_vectors``."""
        known = self._words
        out = list(map(known.get, words))
        if None in out:
            for w in words:
                if w not in known:
                    i = known[w] = len(known)
                    if i == len(self._vectors):
                        self._vectors = np.concatenate((self._vectors, np.zeros_like(self._vectors)))
                    self._vectors[i] = self.weights[ngrams(w)].sum(axis=0)
            out = list(map(known.get, words))
        return out

    def forget(self, most: int = 200_000) -> None:
        """Drops the words that were met if there are too many of them."""
        if len(self._words) > most:
            self._words, self._vectors = {}, np.zeros((1024, len(LANGUAGES)), np.float32)

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        """For each text, given as words, the sum of evidence for each language."""
        self.forget()
        ids, ends = [], np.zeros(len(texts) + 1, np.int64)
        for k, words in enumerate(texts):
            ids += self.word_ids(words)
            ends[k + 1] = len(ids)
        out = np.zeros((len(texts), len(LANGUAGES)), np.float32)
        has = np.flatnonzero(np.diff(ends))
        if len(has):
            out[has] = np.add.reduceat(self._vectors[ids], ends[has], axis=0)
        return out


def _shares(texts: Iterable[str]) -> np.ndarray:
    """The share of each bucket in all n-grams of the texts."""
    met = Counter(w for t in texts for w in WORD.findall(t.lower()))
    counts = np.zeros(BUCKETS)
    for w, n in met.items():
        counts[ngrams(w)] += n  # a bucket that two n-grams of a word share counts once
    return counts / max(1.0, counts.sum())


def weigh(shares: np.ndarray) -> np.ndarray:
    """Weights from the share of each n-gram (rows) in each language (columns): the log of its excess over the average language."""
    average = shares.mean(axis=1, keepdims=True)
    ratio = np.divide(shares, average, out=np.ones_like(shares), where=average > 0)
    return np.log(BACKGROUND + (1 - BACKGROUND) * ratio).astype(np.float32)


def learn(texts: list[str], margin: float = 8.0) -> Languages:
    """The classifier of the seeds, which then learns from those ``texts`` whose language it tells with at least ``margin``.

    Half of the weight of a language that is met stays with its seed.
    """
    seeds = np.stack([_shares([SEEDS[lang]]) for lang in LANGUAGES], axis=1)
    first = Languages(weigh(seeds))
    got = first.scores([WORD.findall(t.lower()) for t in texts]) if texts else np.zeros((0, len(LANGUAGES)))
    two = np.sort(got, axis=1)[:, -2:]
    best = got.argmax(axis=1)
    shares = seeds.copy()
    for k in range(len(LANGUAGES)):
        own = [t for t, b, (second, top) in zip(texts, best, two) if b == k and top - second >= margin]
        if own:
            shares[:, k] = 0.5 * seeds[:, k] + 0.5 * _shares(own)
    return Languages(weigh(shares))
