"""Wordings that the synthetic defects of problem 1 are made of, put together at random from parts.

They are general English, German, French and so on, written without regard to any table; tests hold the classifier against
other wordings. ``{v}`` stands for what an assistant does, ``{o}`` for what it was asked for, ``{t}`` for a thing of ordinary
life, ``{n}`` for a name.
"""

from __future__ import annotations

import random
import re

# --- refusals: an opening, a statement of unwillingness with its object, perhaps an ending

OPENINGS = {
    "en": ("", "", "", "", "I'm sorry, but ", "I am sorry, but ", "I'm sorry. ", "Sorry, ", "Sorry, but ", "So sorry, ", "My apologies, ", "I apologize, but ", "I apologise, ", "Apologies, but ", "Unfortunately, ", "Unfortunately ", "Sadly, ", "Regrettably, ", "I'm afraid ", "I am afraid that ", "I regret that ", "I regret to say that ", "As an AI, ", "As an AI assistant, ", "As an AI language model, ", "As a language model, ", "As an assistant, ", "As a chatbot, ", "Being an AI, ", "Thank you for asking, but ", "Thanks for reaching out. ", "I appreciate your message, but ", "I understand the request, but ", "I understand what you are asking, however, ", "I see what you want, but ", "While I understand your goal, ", "With all due respect, ", "Respectfully, ", "No, ", "No. ", "Hello. ", "Hi there, ", "Oh, ", "Hm, ", "Look, ", "To be honest, ", "To be clear, ", "Just to be clear, ", "Please note that ", "After some thought, ", "Having read this, ", "Having considered it, ", "Given my guidelines, ", "For safety reasons, ", "For ethical reasons, ", "Due to my content policy, ", "Under my rules ", "Per my instructions ", "In keeping with my principles, ", "This is a sensitive topic, so ", "Because this may cause harm, "),
    "de": ("", "", "Es tut mir leid, aber ", "Tut mir leid, ", "Entschuldigung, ", "Entschuldigen Sie, ", "Leider ", "Bedauerlicherweise ", "Als KI ", "Als KI-Assistent ", "Als Sprachmodell ", "Als Assistent ", "Danke für die Anfrage, aber ", "Ich verstehe die Bitte, aber ", "Nein, ", "Aus Sicherheitsgründen ", "Nach meinen Richtlinien "),
    "fr": ("", "", "Je suis désolé, mais ", "Je suis désolée, ", "Désolé, ", "Désolé, mais ", "Pardon, ", "Malheureusement, ", "Hélas, ", "En tant qu'IA, ", "En tant qu'assistant, ", "En tant que modèle de langage, ", "Merci pour votre message, mais ", "Je comprends la demande, mais ", "Non, ", "Pour des raisons de sécurité, ", "Selon mes règles, "),
    "es": ("", "", "Lo siento, pero ", "Lo siento, ", "Lo lamento, ", "Perdón, ", "Disculpe, ", "Lamentablemente, ", "Por desgracia, ", "Como IA, ", "Como asistente, ", "Como modelo de lenguaje, ", "Gracias por tu mensaje, pero ", "Entiendo la petición, pero ", "No, ", "Por motivos de seguridad, ", "Según mis normas, "),
    "it": ("", "Mi dispiace, ma ", "Mi dispiace, ", "Scusa, ", "Purtroppo ", "Come IA, ", "Come assistente, ", "In quanto modello linguistico, ", "Capisco la richiesta, ma "),
    "pt": ("", "Desculpe, mas ", "Desculpa, ", "Sinto muito, mas ", "Lamento, mas ", "Infelizmente, ", "Como IA, ", "Como assistente, ", "Entendo o pedido, mas "),
    "nl": ("", "Het spijt me, maar ", "Sorry, maar ", "Sorry, ", "Helaas ", "Als AI ", "Als assistent ", "Ik begrijp het verzoek, maar "),
    "pl": ("", "Przepraszam, ale ", "Przykro mi, ale ", "Niestety ", "Jako AI ", "Jako asystent "),
    "ru": ("", "", "Извините, но ", "Извините, ", "Простите, ", "Прошу прощения, но ", "К сожалению, ", "Сожалею, но ", "Как ИИ, ", "Как помощник, ", "Как языковая модель, ", "Я понимаю просьбу, но ", "Нет, ", "По соображениям безопасности "),
    "ja": ("", "", "申し訳ありませんが、", "申し訳ございませんが、", "すみませんが、", "ごめんなさい、", "恐れ入りますが、", "残念ながら、", "AIとして、", "アシスタントとして、", "安全上の理由により、"),
    "zh": ("", "抱歉，", "很抱歉，", "对不起，", "不好意思，", "作为人工智能，", "作为助手，", "很遗憾，"),
    "ko": ("", "죄송하지만 ", "미안하지만 ", "유감스럽게도 ", "AI로서 "),
}
#: Unwillingness that a verb of the task follows.
UNWILLING = {
    "en": ("I can't {v} {o}", "I cannot {v} {o}", "I can not {v} {o}", "I could not {v} {o}", "I'm unable to {v} {o}", "I am unable to {v} {o}", "I'm not able to {v} {o}", "I am not able to {v} {o}", "I won't {v} {o}", "I will not {v} {o}", "I'm not going to {v} {o}", "I won't be able to {v} {o}", "I don't think I can {v} {o}", "I do not think I should {v} {o}", "I shouldn't {v} {o}", "I may not {v} {o}", "I'm not allowed to {v} {o}", "I am not permitted to {v} {o}", "I'm not willing to {v} {o}", "I'd rather not {v} {o}", "I would prefer not to {v} {o}", "I'm not comfortable with {g} {o}", "I am not comfortable {g} {o}", "I don't feel comfortable {g} {o}", "I refuse to {v} {o}", "I decline to {v} {o}", "I must decline to {v} {o}", "I have to decline {g} {o}", "I need to decline to {v} {o}", "I have to refuse to {v} {o}", "I choose not to {v} {o}", "it is not possible for me to {v} {o}", "it isn't appropriate for me to {v} {o}", "it would be wrong of me to {v} {o}", "it would not be right to {v} {o}", "my guidelines don't allow me to {v} {o}", "my guidelines prevent me from {g} {o}", "my safety rules prevent me from {g} {o}", "my policies forbid {g} {o}", "my programming doesn't let me {v} {o}", "I was instructed not to {v} {o}", "I'm designed not to {v} {o}", "I have no way to {v} {o}", "I'm not in a position to {v} {o}", "I do not have permission to {v} {o}", "there is no way I can {v} {o}", "I am going to refrain from {g} {o}", "I have to stop short of {g} {o}", "{g} {o} is against my rules", "{g} {o} isn't something I can do", "{g} {o} is not something I do", "{g} {o} goes beyond what I am able to do"),
    "de": ("ich kann {o} nicht {v}", "ich darf {o} nicht {v}", "ich werde {o} nicht {v}", "ich möchte {o} nicht {v}", "kann ich {o} nicht {v}", "darf ich {o} nicht {v}", "werde ich {o} nicht {v}", "es ist mir nicht möglich, {o} zu {v}", "ich bin nicht in der Lage, {o} zu {v}", "ich weigere mich, {o} zu {v}", "ich lehne es ab, {o} zu {v}", "meine Richtlinien erlauben mir nicht, {o} zu {v}", "ich sehe mich außerstande, {o} zu {v}"),
    "fr": ("je ne peux pas {v} {o}", "je ne pourrai pas {v} {o}", "je ne vais pas {v} {o}", "je ne souhaite pas {v} {o}", "je refuse de {v} {o}", "je dois refuser de {v} {o}", "je ne suis pas en mesure de {v} {o}", "je ne suis pas autorisé à {v} {o}", "il m'est impossible de {v} {o}", "il ne m'est pas possible de {v} {o}", "mes règles m'interdisent de {v} {o}", "mes consignes ne me permettent pas de {v} {o}", "je préfère ne pas {v} {o}"),
    "es": ("no puedo {v} {o}", "no podré {v} {o}", "no voy a {v} {o}", "no debo {v} {o}", "no quiero {v} {o}", "me niego a {v} {o}", "debo negarme a {v} {o}", "no soy capaz de {v} {o}", "no estoy autorizado a {v} {o}", "no me es posible {v} {o}", "me resulta imposible {v} {o}", "mis normas no me permiten {v} {o}", "prefiero no {v} {o}"),
    "it": ("non posso {v} {o}", "non sono in grado di {v} {o}", "mi rifiuto di {v} {o}", "devo rifiutarmi di {v} {o}", "non mi è possibile {v} {o}", "le mie regole non mi permettono di {v} {o}", "preferisco non {v} {o}"),
    "pt": ("não posso {v} {o}", "não consigo {v} {o}", "não vou {v} {o}", "recuso-me a {v} {o}", "preciso recusar {v} {o}", "não me é possível {v} {o}", "as minhas regras não permitem {v} {o}", "prefiro não {v} {o}"),
    "nl": ("ik kan {o} niet {v}", "ik mag {o} niet {v}", "ik zal {o} niet {v}", "kan ik {o} niet {v}", "mag ik {o} niet {v}", "ik weiger {o} te {v}", "ik ben niet in staat {o} te {v}", "mijn regels staan niet toe {o} te {v}"),
    "pl": ("nie mogę {v} {o}", "nie będę {v} {o}", "nie jestem w stanie {v} {o}", "muszę odmówić, nie wolno mi {v} {o}", "odmawiam, nie chcę {v} {o}", "moje zasady nie pozwalają mi {v} {o}"),
    "ru": ("я не могу {v} {o}", "я не смогу {v} {o}", "я не буду {v} {o}", "мне нельзя {v} {o}", "я отказываюсь {v} {o}", "я вынужден отказаться {v} {o}", "у меня нет возможности {v} {o}", "я не в состоянии {v} {o}", "мои правила не позволяют мне {v} {o}", "мне не разрешено {v} {o}", "я не хочу {v} {o}"),
    "ja": ("{o}{v}ことはできません", "{o}{v}ことができません", "{o}{v}わけにはいきません", "{o}{v}ことは致しかねます", "{o}{v}ことは許可されていません", "{o}{v}のは控えさせていただきます"),
    "zh": ("我不能{v}{o}", "我无法{v}{o}", "我没有办法{v}{o}", "我不会{v}{o}", "我拒绝{v}{o}", "我不被允许{v}{o}", "我的规则不允许我{v}{o}"),
    "ko": ("{o} {v} 수 없습니다", "{o} {v} 수가 없어요", "{o} {v} 수 없게 되어 있습니다"),
}
#: What an assistant does: the plain form, and in English the form in -ing.
DOING = {
    "en": ("do|doing", "do|doing", "help with|helping with", "assist with|assisting with", "help with|helping with", "assist with|assisting with", "help you with|helping you with", "assist you with|assisting you with", "write|writing", "produce|producing", "generate|generating", "create|creating", "provide|providing", "complete|completing", "continue|continuing", "continue with|continuing with", "rewrite|rewriting", "rephrase|rephrasing", "compose|composing", "draft|drafting", "fulfill|fulfilling", "comply with|complying with", "carry out|carrying out", "do|doing", "perform|performing", "answer|answering", "respond to|responding to", "reply to|replying to", "engage with|engaging with", "engage in|engaging in", "support|supporting", "process|processing", "proceed with|proceeding with", "go along with|going along with", "take part in|taking part in", "deliver|delivering", "make|making", "give you|giving you", "supply|supplying", "finish|finishing", "work on|working on", "follow|following", "handle|handling", "take on|taking on", "discuss|discussing", "share|sharing", "imitate|imitating", "role-play|role-playing", "simulate|simulating", "offer|offering", "author|authoring", "script|scripting", "formulate|formulating", "phrase|phrasing", "put together|putting together", "come up with|coming up with", "output|outputting", "put into words|putting into words", "add to|adding to", "contribute to|contributing to", "cooperate with|cooperating with", "accept|accepting", "grant|granting", "honor|honoring", "pretend to be part of|pretending to be part of", "act out|acting out", "speak for|speaking for", "make up|making up", "degrade|degrading", "worsen|worsening", "alter|altering", "edit|editing"),
    "de": ("beantworten", "schreiben", "erstellen", "verfassen", "erzeugen", "bearbeiten", "ausführen", "erfüllen", "fortsetzen", "umschreiben", "liefern", "unterstützen", "machen", "tun", "bereitstellen", "übernehmen"),
    "fr": ("aider avec", "répondre à", "écrire", "rédiger", "produire", "générer", "créer", "fournir", "continuer", "poursuivre", "réécrire", "compléter", "faire", "traiter", "exécuter", "donner suite à"),
    "es": ("ayudar con", "ayudarte con", "responder a", "escribir", "redactar", "producir", "generar", "crear", "ofrecer", "continuar", "seguir con", "reescribir", "completar", "hacer", "cumplir", "realizar", "proporcionar"),
    "it": ("aiutare con", "rispondere a", "scrivere", "produrre", "generare", "creare", "fornire", "continuare", "riscrivere", "completare", "fare", "soddisfare"),
    "pt": ("ajudar com", "responder a", "escrever", "produzir", "gerar", "criar", "fornecer", "continuar", "reescrever", "completar", "fazer", "atender"),
    "nl": ("beantwoorden", "schrijven", "maken", "genereren", "voortzetten", "herschrijven", "uitvoeren", "leveren", "doen"),
    "pl": ("napisać", "pisać", "wykonać", "stworzyć", "kontynuować", "przepisać", "spełnić", "zrobić", "wygenerować"),
    "ru": ("написать", "писать", "создать", "создавать", "выполнить", "выполнять", "продолжить", "переписать", "составить", "сгенерировать", "ответить на", "обработать", "сделать", "предоставить"),
    "ja": ("作成する", "書く", "生成する", "続ける", "書き換える", "手伝う", "提供する", "実行する", "お答えする", "対応する"),
    "zh": ("撰写", "生成", "写", "提供", "完成", "继续", "改写", "协助", "回答", "处理", "满足", "执行"),
    "ko": ("작성할", "생성할", "도와드릴", "제공할", "계속할", "수행할", "답변할", "처리할"),
}
ASKED_FOR = {
    "en": ("that", "that", "this", "this", "it", "that request", "this request", "your request", "the request", "such a request", "requests like this", "this task", "the task", "that task", "tasks of this kind", "this assignment", "this prompt", "the prompt", "these instructions", "those instructions", "instructions like these", "this kind of content", "that sort of content", "content of this type", "content like that", "such content", "harmful content", "offensive material", "this material", "such material", "this text", "the text you want", "text of that sort", "a text like this", "the reply you want", "a response to this", "a response here", "an answer to that", "this conversation", "this dialogue", "the dialogue as described", "this exchange in that way", "the rest of this exchange", "the next messages", "the following turns", "the remaining turns", "a new version of this", "a weaker version of this", "a worse version", "a version like that", "the alternative version", "this scenario", "this scene", "this story", "that topic", "what you ask", "what you're asking for", "what was asked", "anything like this", "anything of the sort", "any of this", "either of these", "the requested text", "the requested output", "the desired output", "messages on behalf of these people", "that passage", "passages of this kind", "those lines", "such lines", "a paragraph like that", "this piece", "this narrative", "that statement", "statements like these", "this wording", "this transcript", "a completion for this", "this completion", "the draft you describe", "prompts of this kind", "hurtful words", "anything hurtful", "something misleading", "a rude reply", "a less helpful answer", "a deliberately bad answer", "a worse reply on purpose", "a less coherent dialogue", "less empathetic messages", "false statements", "stereotypes", "content about this subject", "this type of writing", "this style of writing", "the words of real people", "this role", "this any further"),
    "de": ("das", "dies", "diese Anfrage", "die Anfrage", "Ihre Anfrage", "deine Bitte", "diese Aufgabe", "den Auftrag", "solche Inhalte", "diesen Inhalt", "diesen Text", "so einen Text", "den gewünschten Text", "dieses Gespräch", "diesen Dialog", "die Antwort", "eine solche Version", "eine schlechtere Fassung", "so etwas", "diese Anweisung", "dieses Thema"),
    "fr": ("cela", "ça", "cette demande", "votre demande", "cette requête", "cette tâche", "ce type de contenu", "un tel contenu", "ce texte", "un tel texte", "le texte voulu", "cette conversation", "ce dialogue", "la suite", "une réponse", "une version pareille", "une version moins bonne", "ces instructions", "ce sujet", "ce que vous demandez"),
    "es": ("eso", "esto", "esa petición", "tu solicitud", "su solicitud", "esta tarea", "ese tipo de contenido", "contenido así", "este texto", "un texto así", "el texto que pides", "esta conversación", "este diálogo", "una respuesta", "una versión peor", "esas instrucciones", "este tema", "lo que pides"),
    "it": ("questo", "ciò", "questa richiesta", "la tua richiesta", "questo compito", "questo tipo di contenuto", "questo testo", "un testo simile", "questa conversazione", "questo dialogo", "una risposta del genere", "quello che chiedi"),
    "pt": ("isso", "isto", "este pedido", "a sua solicitação", "esta tarefa", "esse tipo de conteúdo", "este texto", "um texto assim", "esta conversa", "este diálogo", "uma resposta dessas", "o que você pede"),
    "nl": ("dat", "dit", "dit verzoek", "uw verzoek", "deze taak", "deze opdracht", "zulke inhoud", "deze tekst", "dit gesprek", "zo'n antwoord", "zoiets"),
    "pl": ("tego", "tej prośby", "tego zadania", "takiej treści", "takiego tekstu", "tej rozmowy", "takiej odpowiedzi", "czegoś takiego"),
    "ru": ("это", "этот запрос", "ваш запрос", "вашу просьбу", "это задание", "такую задачу", "такое содержание", "такой материал", "подобный текст", "этот текст", "этот разговор", "такой ответ", "такую версию", "худшую версию", "подобное", "эти указания"),
    "ja": ("それを", "これを", "そのご依頼を", "この要求を", "このタスクを", "このような内容を", "そうした文章を", "この会話を", "その返答を", "ご要望の文章を", "この話題に"),
    "zh": ("这个", "这个请求", "您的请求", "你的要求", "这项任务", "此类内容", "这样的文本", "这段对话", "这种回复", "这些指示", "这个话题"),
    "ko": ("그것을", "이 요청을", "요청하신 것을", "이 작업을", "이런 내용을", "이런 글을", "이 대화를", "그런 답변을"),
}
#: Refusals that need no verb of the task.
OUTRIGHT = {
    "en": ("I can't do that", "I cannot do this", "I can't do it", "I won't do that", "I will not do this", "I'm not doing that", "I am not able to do so", "I'm unable to do so", "I cannot comply", "I can't comply", "I won't comply", "I will not comply with that", "I can't help you there", "I can't help you with that", "I'm unable to help", "I am not able to help here", "I can't assist", "I cannot assist you further", "I must decline", "I'll have to decline", "I will have to decline this", "I respectfully decline", "I decline", "I must refuse", "I have to refuse", "I refuse", "I will pass", "I'd have to say no", "I have to say no to this", "my answer is no, that isn't allowed", "that's not something I can do", "this is not something I can help with", "that is something I'm not able to provide", "it's something I won't write", "that isn't possible for me", "this isn't allowed", "that would go against my guidelines", "this goes against my policy", "this would violate my guidelines", "your request violates the content policy", "this request is outside of what I can do", "that falls outside my abilities", "what you ask for is not appropriate", "this content is not appropriate", "such text would be inappropriate", "the request cannot be completed", "this request can't be fulfilled", "request denied", "your request was declined", "no response can be given to this", "I can't provide a response", "an answer to this is not possible", "I can only help with other kinds of questions", "my guidelines stop me here", "my rules don't permit it", "I'm not permitted to answer", "I am programmed to avoid this", "I don't do that kind of writing", "I would rather not", "that is where I draw the line", "our terms don't allow such a text", "the policies I follow rule this out", "my developers do not allow it", "it conflicts with my principles", "that conflicts with the values I was given", "I am restricted from doing that", "this is outside my scope", "that lies beyond the limits of what I may write", "I need to skip this prompt", "I'll stop here instead", "I have been told to reject such prompts", "I have to turn this request down", "answering this would break my rules", "I don't feel right about this request", "we are unable to complete this request", "we cannot provide this content", "content of this kind is not permitted", "this prompt is off limits", "it is against policy", "I do not generate that kind of content"),
    "de": ("das kann ich nicht tun", "das kann ich nicht machen", "das geht leider nicht", "dabei kann ich nicht helfen", "damit kann ich Ihnen nicht helfen", "da kann ich nicht weiterhelfen", "ich muss ablehnen", "ich muss diese Bitte ablehnen", "ich lehne das ab", "das darf ich nicht", "das ist mir nicht erlaubt", "das verstößt gegen meine Richtlinien", "dazu bin ich nicht befugt", "diese Anfrage kann nicht bearbeitet werden", "Anfrage abgelehnt", "so etwas schreibe ich nicht", "diese Bitte muss ich ablehnen", "diesen Wunsch kann ich nicht erfüllen", "das kann ich so nicht schreiben", "darauf darf ich nicht antworten"),
    "fr": ("je ne peux pas faire cela", "je ne peux pas vous aider", "je ne peux pas t'aider là-dessus", "je ne le ferai pas", "je dois refuser", "je refuse", "je décline", "c'est contraire à mes règles", "cela va à l'encontre de mes consignes", "cela ne m'est pas permis", "ce n'est pas possible pour moi", "cette demande ne peut pas être traitée", "demande refusée", "je n'écris pas ce genre de choses"),
    "es": ("no puedo hacer eso", "no puedo hacerlo", "no puedo ayudarte", "no puedo ayudarle con eso", "no lo haré", "debo negarme", "me niego", "tengo que rechazarlo", "eso va contra mis normas", "no me está permitido", "eso no es posible para mí", "la solicitud no puede completarse", "solicitud rechazada", "no escribo ese tipo de cosas", "no me siento cómodo con esta petición", "no me parece correcto escribir esto"),
    "it": ("non posso farlo", "non posso aiutarti", "non lo farò", "devo rifiutare", "mi rifiuto", "è contrario alle mie regole", "richiesta rifiutata"),
    "pt": ("não posso fazer isso", "não posso ajudar", "não posso ajudá-lo com isso", "não farei isso", "tenho de recusar", "recuso", "isso vai contra as minhas regras", "pedido recusado"),
    "nl": ("dat kan ik niet doen", "daar kan ik niet bij helpen", "dat doe ik niet", "ik moet weigeren", "dat mag ik niet", "dit gaat tegen mijn regels in", "verzoek geweigerd"),
    "pl": ("nie mogę tego zrobić", "nie mogę w tym pomóc", "nie zrobię tego", "muszę odmówić", "odmawiam", "to jest sprzeczne z moimi zasadami"),
    "ru": ("я не могу этого сделать", "я не могу помочь", "я не могу вам с этим помочь", "я этого не сделаю", "я вынужден отказать", "я должен отказаться", "я отказываюсь", "это противоречит моим правилам", "мне это запрещено", "это для меня невозможно", "запрос не может быть выполнен", "запрос отклонён", "я такого не пишу"),
    "ja": ("それはできません", "お手伝いできません", "お答えできません", "対応できません", "ご要望にはお応えできません", "お断りします", "お断りいたします", "それは許可されていません", "それは私のガイドラインに反します", "そのご依頼はお受けできません", "そのような内容は書けません", "その文章は作成いたしかねます", "ご依頼の内容は作成できません"),
    "zh": ("我不能这样做", "我做不到", "我无法帮忙", "我帮不了您", "我必须拒绝", "我拒绝", "这违反了我的准则", "这是不允许的", "请求被拒绝", "我不写这样的内容"),
    "ko": ("그렇게 할 수 없습니다", "도와드릴 수 없습니다", "거절해야 합니다", "거절하겠습니다", "제 지침에 어긋납니다", "허용되지 않습니다"),
}
ENDINGS = {
    "en": ("", "", "", "", " Please ask something else.", " Please try another request.", " Is there something else I can do for you?", " How else can I help?", " I'd be glad to help with another question.", " I hope you understand.", " Thank you for understanding.", " It could hurt someone.", " It might cause harm.", " It could be seen as disrespectful.", " That would not be ethical.", " If you like, I can suggest something kinder.", " I can instead offer a summary.", " Feel free to rephrase.", " Consider asking in a different way.", " This is against the rules I follow.", " Instead, let's talk about something positive."),
    "de": ("", "", " Bitte frag etwas anderes.", " Kann ich sonst noch helfen?", " Ich bitte um Verständnis.", " Das könnte jemanden verletzen.", " Gern helfe ich bei einer anderen Frage."),
    "fr": ("", "", " Posez une autre question, s'il vous plaît.", " Puis-je vous aider autrement ?", " Merci de votre compréhension.", " Cela pourrait blesser quelqu'un."),
    "es": ("", "", " Pregunta otra cosa, por favor.", " ¿Puedo ayudarte en algo más?", " Gracias por tu comprensión.", " Podría hacer daño a alguien."),
    "it": ("", "", " Posso aiutarti in altro modo?", " Grazie per la comprensione."),
    "pt": ("", "", " Posso ajudar com outra coisa?", " Obrigado pela compreensão."),
    "nl": ("", "", " Kan ik ergens anders mee helpen?"),
    "pl": ("", "", " Czy mogę pomóc w czymś innym?"),
    "ru": ("", "", " Задайте, пожалуйста, другой вопрос.", " Могу ли я помочь чем-то ещё?", " Спасибо за понимание.", " Это может кого-то обидеть."),
    "ja": ("", "", "別の質問をどうぞ。", "他にお手伝いできることはありますか。", "ご理解ください。"),
    "zh": ("", "", "请换一个问题。", "还有什么可以帮您的吗？"),
    "ko": ("", "", " 다른 질문을 해 주세요."),
}

# --- speakers who decline or regret something in their own lives

THINGS = {
    "en": "party dinner wedding meeting concert trip cake soup bread coffee guitar bicycle car keys phone letter book ladder sofa garden roof window door dog cat kitchen bill rent ticket train bus flight doctor hospital school homework exam teacher neighbor uncle aunt grandmother boss job interview shop market money coat shoes dress camera picture song movie game match weekend holiday beach river mountain snow rain fire medicine headache knee back shoulder surprise present invitation promotion offer apartment house furniture suitcase passport recipe fence lawn engine battery television museum choir painting".split(),
    "de": "Feier Hochzeit Suppe Fahrrad Auto Leiter Garten Küche Rechnung Arbeit Schule Oma Nachbarin Reise Wohnung Lampe Brief Jacke".split(),
    "fr": "fête soirée soupe voiture échelle jardin cuisine facture école voisine lettre lampe valise veste réunion maison".split(),
    "es": "fiesta cena sopa bicicleta escalera cocina factura escuela vecina carta lámpara maleta chaqueta reunión casa boda".split(),
    "ru": "праздник ужин суп велосипед лестницу кухню счёт школу соседку письмо лампу чемодан куртку встречу квартиру".split(),
}
DECLINED = {
    "en": ("I can't come to the {t}", "I can't make it to the {t} tonight", "I won't be at the {t}", "I cannot afford the {t}", "I can't bring the {t} today", "I couldn't find the {t} anywhere", "I can't find my {t}", "I can't lend you my {t} this week", "I'm not able to lift the {t}", "I am unable to fix the {t} before Friday", "I can't help you with the {t}, ask {n}", "I can't help {n} move the {t}", "I won't help with the {t} this time", "I must decline the {t}, it is too late for me", "I have to decline the {t}, thank you", "I'd rather not sell the {t}", "I would rather not go to the {t}", "I refuse to pay for the {t}", "I refuse to eat the {t}", "I will not clean the {t} again", "I'm not going to the {t} with {n}", "I can't write the {t} without my glasses", "I can't answer the {t} right now, I am driving", "I can't finish the {t} alone", "I cannot continue with the {t}, my back hurts", "I can't give you the {t}, it belongs to {n}", "I'm not allowed to drive the {t}", "I am not permitted to leave the {t} before six", "I don't think I can carry the {t}", "I'm not comfortable with the {t} at night", "I can't stand the {t}", "I can't believe the {t} is over", "I can't wait for the {t}", "it is not possible to open the {t}", "my {t} won't let me sleep", "my boss doesn't allow me to take the {t} home", "the doctor said I must not lift the {t}", "{n} refused to talk about the {t}", "{n} cannot come", "{n} can't come tonight", "{n} won't be there", "{n} and I cannot come", "{n} is not able to bring the {t}", "{n} cannot come, because of the {t}", "{n} declined the {t}", "the bank declined my request for the {t}", "I can't do that to {n}", "I can't talk to {n} about it", "I can't help it, the {t} makes me sad", "I can't say the {t} was good", "I can't create a {t} out of nothing", "I can't provide for a {t} and a family", "the rules at the {t} don't allow dogs", "that {t} is not appropriate for a child"),
    "de": ("ich kann nicht zur {t} kommen", "ich kann die {t} heute nicht bringen", "{n} kann leider nicht kommen", "ich muss die {t} absagen", "ich kann dir die {t} nicht leihen", "ich finde meine {t} nicht", "ich darf nach der {t} kein Auto fahren", "ich kann {n} bei der {t} nicht helfen", "ich will die {t} nicht verkaufen"),
    "fr": ("je ne peux pas venir à la {t}", "je ne peux pas apporter la {t} ce soir", "{n} ne peut pas venir", "je dois annuler la {t}", "je ne peux pas te prêter la {t}", "je ne trouve pas ma {t}", "je refuse de payer la {t}", "je ne peux pas aider {n} avec la {t}"),
    "es": ("no puedo ir a la {t}", "no puedo llevar la {t} esta noche", "{n} no puede venir", "tengo que cancelar la {t}", "no puedo prestarte la {t}", "no encuentro mi {t}", "me niego a pagar la {t}", "no puedo ayudar a {n} con la {t}"),
    "ru": ("я не могу принести {t} сегодня", "{n} не может прийти", "я не могу найти {t}", "я не могу одолжить тебе {t}", "я отказываюсь платить за {t}", "я не смогу помочь {n} нести {t}", "мне нельзя поднимать {t}"),
}
#: What people do, for the same statements of unwillingness as above.
EVERYDAY = {
    "en": ("eat|eating", "eat sugar|eating sugar", "drink|drinking", "drink milk|drinking milk", "park|parking there", "park here|parking here", "walk|walking", "walk that far|walking that far", "run|running", "sleep|sleeping", "sleep at night|sleeping at night", "swim|swimming", "drive|driving", "drive at night|driving at night", "stay|staying", "stay longer|staying longer", "leave|leaving", "leave him|leaving him", "leave early|leaving early", "go|going", "go there|going there", "go home|going home", "go on|going on", "go out|going out", "come|coming", "come back|coming back", "come along|coming along", "talk to him|talking to him", "talk to her again|talking to her again", "talk now|talking now", "speak to them|speaking to them", "call him|calling him", "see you|seeing you", "see them|seeing them", "meet her|meeting her", "meet {n}|meeting {n}", "visit {n}|visiting {n}", "forgive him|forgiving him", "forget it|forgetting it", "forget her|forgetting her", "trust them|trusting them", "marry {n}|marrying {n}", "tell {n}|telling {n}", "tell anyone|telling anyone", "lie to {n}|lying to {n}", "lose {n}|losing {n}", "wait|waiting", "wait any longer|waiting any longer", "pay|paying", "pay for everything|paying for everything", "buy the {t}|buying the {t}", "sell the {t}|selling the {t}", "use the {t}|using the {t}", "open the {t}|opening the {t}", "clean the {t}|cleaning the {t}", "miss the {t}|missing the {t}", "finish the {t}|finishing the {t}", "start the {t}|starting the {t}", "carry the {t}|carrying the {t}", "fix the {t}|fixing the {t}", "leave the {t}|leaving the {t}", "complete the {t}|completing the {t}", "continue the {t}|continuing the {t}", "write to {n}|writing to {n}", "write by hand|writing by hand", "write that letter|writing that letter", "answer the door|answering the door", "answer his calls|answering his calls", "help {n} with the {t}|helping {n} with the {t}", "help my brother|helping my brother", "help them move|helping them move", "help with the {t}|helping with the {t}", "support a family|supporting a family", "discuss the {t} with him|discussing the {t} with him", "share the {t}|sharing the {t}", "make dinner|making dinner", "make the {t}|making the {t}", "make it|making it", "do the dishes|doing the dishes", "do the {t}|doing the {t}", "do this job|doing this job", "work on Sundays|working on Sundays", "work with him|working with him", "give up|giving up", "give it to {n}|giving it to {n}", "give him money|giving him money", "follow him|following him", "hear you|hearing you", "sing|singing", "dance|dancing", "cook|cooking", "breathe|breathing", "stand up|standing up", "lift it|lifting it", "reach it|reaching it", "find it|finding it", "find my {t}|finding my {t}", "remember his name|remembering his name", "afford it|affording it", "quit|quitting", "smoke|smoking", "cry|crying", "fight|fighting", "study|studying", "sign the papers|signing the papers", "take a second slice|taking a second slice", "take the {t}|taking the {t}", "take her call|taking her call", "handle the {t}|handling the {t}", "change the past|changing the past", "say goodbye|saying goodbye", "blame them|blaming them", "bring my dog|bringing my dog", "accept the offer|accepting the offer", "finish this|finishing this", "finish this {t}|finishing this {t}", "follow the story|following the story", "follow the {t}|following the {t}", "read the {t}|reading the {t}", "read this|reading this", "hold the {t}|holding the {t}", "keep the {t}|keeping the {t}", "keep pets|keeping pets", "live|living", "live here|living here", "move|moving", "play|playing", "play the {t}|playing the {t}", "win|winning", "lose|losing", "look at it|looking at it", "listen to him|listening to him", "think straight|thinking straight", "imagine it|imagining it", "explain it to {n}|explaining it to {n}", "promise|promising", "promise anything|promising anything", "hurt {n}|hurting {n}", "hide it|hiding it", "ask {n}|asking {n}", "believe {n}|believing {n}", "thank you enough|thanking you enough", "enjoy the {t}|enjoying the {t}", "stop|stopping", "stop crying|stopping", "get up|getting up", "get the {t}|getting the {t}", "sit down|sitting down", "turn back|turning back", "retire|retiring", "drop the {t}|dropping the {t}", "return the {t}|returning the {t}"),
    "de": ("schlafen", "arbeiten", "kommen", "bleiben", "warten", "zahlen", "fahren", "gehen", "vergessen", "essen", "finden", "verstehen", "tragen", "heben", "reparieren", "kaufen", "verkaufen"),
    "fr": ("dormir", "venir", "rester", "partir", "attendre", "payer", "conduire", "manger", "marcher", "oublier", "porter", "trouver", "travailler demain", "aider mon frère", "comprendre", "continuer les études"),
    "es": ("dormir", "ir", "venir", "quedarme", "salir", "esperar", "pagar", "conducir", "comer", "caminar", "olvidar", "llevar", "encontrar", "trabajar mañana", "ayudar a mi hermano", "entender", "seguir en ese trabajo"),
    "it": ("dormire", "venire", "restare", "uscire", "aspettare", "pagare", "guidare", "mangiare", "camminare", "lavorare domani", "aiutare mio fratello"),
    "pt": ("dormir", "ir", "vir", "ficar", "sair", "esperar", "pagar", "dirigir", "comer", "andar", "trabalhar amanhã", "ajudar o meu irmão"),
    "nl": ("slapen", "komen", "blijven", "wachten", "betalen", "rijden", "eten", "vergeten", "dragen", "vinden"),
    "pl": ("spać", "przyjść", "zostać", "czekać", "zapłacić", "jechać", "jeść", "iść", "pracować jutro", "pomóc bratu"),
    "ru": ("спать", "прийти", "остаться", "уйти", "ждать", "платить", "ехать", "есть", "идти", "забыть", "нести", "работать завтра", "помочь брату", "понять", "жить так"),
    "ja": ("眠る", "行く", "来る", "待つ", "払う", "食べる", "歩く", "忘れる", "働く", "兄を手伝う"),
    "zh": ("睡觉", "去", "来", "等", "付钱", "吃饭", "走路", "忘记", "上班", "帮我哥哥"),
    "ko": ("잘", "갈", "올", "기다릴", "먹을", "걸을", "일할"),
}
OBJECTS = {"de": ("meinen Bruder", "die {t}", "das Geld", "heute", "morgen", "ohne {n}", "mit {n}", "den Schlüssel"), "nl": ("morgen", "vandaag", "de sleutel", "het geld"), "ja": ("今夜", "明日は", "一人で", "学校に"), "ko": ("오늘은", "내일은", "혼자서")}
#: When, how and with whom.
WHEN = {
    "en": ("", "", "", " on Sunday", " like this", " like that", " anymore", " with my left hand", " with this knee", " since the accident", " in this heat", " without {n}", " that fast", " tonight", " for you", " alone", " this year", " until Friday", " with you", " so early", " for {n}", " in front of {n}", " this morning", " on my own", " at my age", " because of the {t}"),
    "de": ("", " heute", " so schnell", " ohne {n}", " am Sonntag"),
    "fr": ("", " ce soir", " aussi vite", " sans {n}", " dimanche", " avec ce genou"),
    "es": ("", " esta noche", " tan rápido", " sin {n}", " el domingo", " con esta rodilla"),
    "it": ("", " stasera", " così in fretta", " senza {n}"),
    "pt": ("", " hoje à noite", " tão depressa", " sem {n}"),
    "pl": ("", " dzisiaj", " tak szybko", " bez niego"),
    "ru": ("", " сегодня", " так быстро", " без него", " в воскресенье"),
}
BECAUSE = {
    "en": ("", "", ", I have to work", ", my car broke down", ", because my sister is ill", ". Maybe next week?", ". Can you ask {n}?", ", sorry about that", ". What about you?"),
    "de": ("", ", ich muss arbeiten", ", meine Schwester ist krank", ". Vielleicht nächste Woche?"),
    "fr": ("", ", je dois travailler", ", ma sœur est malade", ". Peut-être demain ?"),
    "es": ("", ", tengo que trabajar", ", mi hermana está enferma", ". ¿Quizás mañana?"),
    "ru": ("", ", мне надо работать", ", моя сестра болеет", ". Может быть, завтра?"),
}
SMALL_TALK = {
    "en": ("I'm sorry to hear that", "I'm so sorry, how is {n} now", "Sorry I'm late", "Sorry, what did you say", "I am sorry for your loss", "I apologize for yesterday", "Unfortunately it rained all day", "I'm afraid of dogs", "I can't sleep", "I can't remember", "I can't wait to see you", "I can't believe it", "I can't complain", "I cannot agree more", "I don't know", "I don't think so", "No, thank you", "No, not yet", "I will not forget that", "I won't tell anyone", "I understand", "I understand how you feel, but {n} means well", "Thank you for asking, I am fine", "I appreciate your help", "That is not fair", "It's not my fault", "That isn't what {n} meant", "I would rather stay home", "I have to go now"),
    "de": ("Das tut mir leid", "Tut mir leid, ich bin zu spät", "Leider hat es geregnet", "Ich kann nicht schlafen", "Das kann ich nicht glauben", "Nein danke", "Ich weiß es nicht", "Ich verstehe dich", "Das war nicht so gemeint", "Darauf wäre ich nie gekommen", "Er hat nie davon erzählt", "Vielleicht morgen, heute passt es nicht", "Niemand hat mich gefragt", "Damit habe ich nicht gerechnet", "Sie mag keinen Kaffee", "Ruf ihn doch später an", "Das wusste ich noch gar nicht", "Mir fällt dazu nichts ein"),
    "fr": ("Je suis désolé pour toi", "Désolé d'être en retard", "Malheureusement il pleuvait", "Je ne peux pas dormir", "Je n'y crois pas", "Non merci", "Je ne sais pas", "Je te comprends", "Ce n'est pas grave", "Je n'y avais jamais pensé", "Il ne m'en a rien dit", "Peut-être demain, aujourd'hui ça ne va pas", "Personne ne m'a demandé", "Je ne m'en souviens plus", "Elle n'aime pas le café", "Appelle-le plus tard", "Je n'en savais rien", "On verra bien ce soir"),
    "es": ("Lo siento mucho", "Perdón por llegar tarde", "Por desgracia llovió", "No puedo dormir", "No puedo creerlo", "No, gracias", "No lo sé", "Te entiendo", "No pasa nada", "Nunca lo había pensado", "No me dijo nada", "Quizás mañana, hoy no me viene bien", "Nadie me preguntó", "Ya no me acuerdo", "No le gusta el café", "Llámalo más tarde", "No tenía ni idea", "Ya veremos esta noche"),
    "it": ("Mi dispiace tanto", "Non riesco a dormire", "No, grazie", "Non lo so", "Non importa", "Non ci avevo mai pensato", "Non mi ha detto niente", "Forse domani, oggi non va bene", "Nessuno me lo ha chiesto", "Non le piace il caffè", "Chiamalo più tardi", "Non ne sapevo nulla", "Vediamo stasera"),
    "pt": ("Sinto muito por isso", "Não consigo dormir", "Não, obrigado", "Não sei", "Não faz mal", "Nunca tinha pensado nisso", "Ele não me disse nada", "Talvez amanhã, hoje não dá", "Ninguém me perguntou", "Ela não gosta de café", "Ligue para ele depois", "Eu não fazia ideia", "Vamos ver hoje à noite"),
    "nl": ("Wat erg voor je", "Ik kan niet slapen", "Nee, dank je", "Ik weet het niet", "Dat geeft niet", "Daar had ik nooit aan gedacht", "Hij heeft er niets over gezegd", "Misschien morgen, vandaag komt het niet uit", "Niemand heeft het me gevraagd", "Ze houdt niet van koffie", "Bel hem later nog eens", "Dat wist ik helemaal niet", "We zien vanavond wel"),
    "pl": ("Przykro mi to słyszeć", "Nie mogę spać", "Nie, dziękuję", "Nie wiem", "Nic się nie stało", "Nigdy o tym nie myślałem", "Nic mi nie powiedział", "Może jutro, dzisiaj mi nie pasuje", "Nikt mnie nie pytał", "Ona nie lubi kawy", "Zadzwoń do niego później", "Zobaczymy wieczorem"),
    "ru": ("Мне очень жаль", "Извините за опоздание", "К сожалению, шёл дождь", "Я не могу уснуть", "Не могу поверить", "Нет, спасибо", "Я не знаю", "Я тебя понимаю", "Ничего страшного", "Я никогда об этом не думал", "Он мне ничего не сказал", "Может быть завтра, сегодня не получится", "Никто меня не спросил", "Она не любит кофе", "Позвони ему позже", "Я об этом не слышал", "Посмотрим вечером"),
    "ja": ("それは残念ですね", "遅れてすみません", "眠れません", "信じられません", "いいえ、結構です", "分かりません", "行けません", "覚えていません"),
    "zh": ("真遗憾", "对不起，我迟到了", "我睡不着", "我不知道", "我不能来", "谢谢，不用了"),
    "ko": ("정말 안타깝네요", "늦어서 미안해요", "잠이 안 와요", "모르겠어요"),
}
SPACELESS = ("ja", "zh")
REFUSAL_LANGUAGES = tuple(OPENINGS)


def _sentence(lang: str, text: str) -> str:
    text = re.sub(r"\s+", " ", text).strip()
    text = text[:1].upper() + text[1:]
    return text if re.search(r"[.?!。？！]$", text) else text + ("。" if lang in SPACELESS else ".")


def refusal(rng: random.Random, lang: str, outright: float = 0.35) -> str:
    """A refusal of a writing task."""
    if rng.random() < outright:
        said = rng.choice(OUTRIGHT[lang])
    else:
        plain, _, going = rng.choice(DOING[lang]).partition("|")
        objects = ASKED_FOR[lang]
        if rng.random() < 0.25:  # the first ones only point
            objects = objects[: 5 if lang == "en" else 2]
        said = rng.choice(UNWILLING[lang]).format(v=plain, g=going or plain, o=rng.choice(objects))
    text = _sentence(lang, ("" if rng.random() < 0.3 else rng.choice(OPENINGS[lang])) + said) + rng.choice(ENDINGS[lang])
    return text.replace("'", "’") if rng.random() < 0.3 else text


def declined(rng: random.Random, lang: str, things: list[str], names: list[str]) -> str:
    """A speaker who declines something of the dialogue: one of the data's ``things``, or of everyday ones."""
    thing = rng.choice(things) if things and lang == "en" and rng.random() < 0.5 else rng.choice(THINGS.get(lang, THINGS["en"]))
    of = dict(t=thing, n=rng.choice(names or ["Sam"]))
    opening = rng.choice(OPENINGS[lang]) if rng.random() < 0.6 else ""
    if lang in DECLINED and rng.random() < 0.55:
        said = rng.choice(DECLINED[lang]).format(**of)
    else:
        plain, _, going = rng.choice(EVERYDAY[lang]).format(**of).partition("|")
        said = rng.choice(UNWILLING[lang]).format(v=plain, g=going or plain, o=(rng.choice(OBJECTS.get(lang, ("",))) + rng.choice(WHEN.get(lang, ("",)))).format(**of))
    text = _sentence(lang, opening + said + rng.choice(BECAUSE.get(lang, ("",))).format(**of))
    return text.replace("'", "’") if rng.random() < 0.3 else text


def in_passing(rng: random.Random, lang: str, sentences: list[str], names: list[str]) -> str:
    """Ordinary talk after an opening that refusals have, too."""
    if rng.random() < 0.35:
        return _sentence(lang, rng.choice(OPENINGS[lang]) + rng.choice(sentences))
    return " ".join(small_talk(rng, lang, names) for _ in range(rng.randrange(1, 3)))


def small_talk(rng: random.Random, lang: str, names: list[str]) -> str:
    return _sentence(lang, rng.choice(SMALL_TALK.get(lang, SMALL_TALK["en"])).format(n=rng.choice(names or ["Sam"])))


# --- answers that stand for "nothing", and short ones that say something

#: What a placeholder says by itself, and what it says of an answer.
ABSENT = {
    "en": ("none", "null", "nil", "nan", "n/a", "na", "not applicable", "not available", "unavailable", "undefined", "empty", "blank", "nothing", "missing", "void", "tbd", "tba", "todo", "deleted", "removed", "omitted", "redacted", "unknown", "no data", "placeholder", "error", "not provided", "left blank", "nothing here", "nothing to add", "skipped"),
    "de": ("leer", "keine", "nichts", "keine Angabe", "k. A.", "fehlt", "nicht vorhanden", "entfällt", "gelöscht", "nicht verfügbar"),
    "fr": ("vide", "aucun", "aucune", "néant", "rien", "manquant", "supprimé", "non disponible", "sans objet"),
    "es": ("vacío", "ninguno", "ninguna", "nada", "falta", "eliminado", "no disponible", "no aplica"),
    "it": ("vuoto", "nessuno", "niente", "mancante", "non disponibile"),
    "pt": ("vazio", "nenhum", "nada", "ausente", "indisponível"),
    "nl": ("leeg", "geen", "niets", "ontbreekt", "niet beschikbaar"),
    "pl": ("brak", "puste", "nic", "nie dotyczy"),
    "ru": ("пусто", "нет", "ничего", "отсутствует", "удалено", "нет данных", "недоступно"),
    "ja": ("なし", "無し", "空", "空白", "未回答", "該当なし", "特になし", "削除済み"),
    "zh": ("无", "空", "空白", "没有", "暂无", "不适用", "已删除"),
    "ko": ("없음", "비어 있음", "해당 없음", "삭제됨"),
}
OF_ANSWER = {
    "en": ("no {a}", "empty {a}", "blank {a}", "{a} missing", "missing {a}", "{a} not found", "{a} unavailable", "no {a} provided", "no {a} given", "no {a} generated", "{a} omitted", "{a} removed", "{a} deleted", "{a} not available", "insert {a} here", "{a} goes here", "without {a}", "no {a} available"),
    "de": ("keine {a}", "kein {a}", "leere {a}", "{a} fehlt", "ohne {a}"),
    "fr": ("aucune {a}", "pas de {a}", "sans {a}", "{a} vide", "{a} manquante"),
    "es": ("sin {a}", "ninguna {a}", "no hay {a}", "{a} vacía"),
    "it": ("nessuna {a}", "senza {a}"),
    "pt": ("sem {a}", "nenhuma {a}"),
    "nl": ("geen {a}", "lege {a}"),
    "pl": ("brak {a}", "bez {a}"),
    "ru": ("нет {a}", "без {a}", "{a} отсутствует"),
    "ja": ("{a}なし", "無{a}", "{a}がありません"),
    "zh": ("无{a}", "没有{a}", "{a}为空"),
    "ko": ("{a} 없음",),
}
ANSWER = {
    "en": ("answer", "response", "reply", "text", "content", "message", "output", "continuation", "data", "value", "result", "comment", "input", "dialogue"),
    "de": ("Antwort", "Text", "Inhalt", "Nachricht", "Ausgabe", "Angaben"),
    "fr": ("réponse", "texte", "contenu", "message", "donnée"),
    "es": ("respuesta", "texto", "contenido", "mensaje", "datos"),
    "it": ("risposta", "testo"),
    "pt": ("resposta", "texto", "conteúdo"),
    "nl": ("antwoord", "reactie", "tekst"),
    "pl": ("odpowiedzi", "tekstu", "treści"),
    "ru": ("ответа", "текста", "сообщения", "содержания", "ответ"),
    "ja": ("回答", "返答", "返信", "内容", "応答"),
    "zh": ("回答", "回复", "内容", "答案"),
    "ko": ("응답", "답변", "내용"),
}
AROUND = (("", ""), ("", ""), ("", ""), ("[", "]"), ("[", "]"), ("(", ")"), ("<", ">"), ("<", ">"), ("{", "}"), ("*", "*"), ("**", "**"), ('"', '"'), ("“", "”"), ("-- ", " --"), ("_", "_"), ("#", ""), ("/", ""), ("", "..."))
MARKS = ("", " ", "\n", "\t ", "...", "…", "—", "--", "-", ".", "?", "!", "''", '""', "“”", "***", "___", "()", "[]", "{}", "<>", "​", "﻿", "⁠", "\xa0", "​ \n", "•", "~", "¯", "*", "。。。", "\U0001f937")
SHORT = {
    "en": ("No", "Yes", "Nothing", "Nothing at all", "Nothing, really", "None", "None of them", "None, I think", "Nobody", "Missing, I fear", "It is missing", "Empty", "It was empty", "Gone", "Never", "Okay", "Sure", "Maybe", "Deleted it", "I removed it", "No answer from {n}", "No reply yet", "No, nothing", "Not yet", "Not available until Monday", "Unknown to me", "Void of sense", "What", "Really", "Both", "{n}", "{n} did", "Ask {n}", "Blank with fear", "Null points, as usual", "He left it blank", "Fine", "Thanks", "Me too"),
    "de": ("Nein", "Ja", "Nichts", "Gar nichts", "Keine", "Keiner", "Sie ist leer", "Weg", "Nie", "Gut", "Frag {n}", "Nichts Neues"),
    "fr": ("Non", "Oui", "Rien", "Rien du tout", "Aucun", "Personne", "Il est vide", "Jamais", "Bien", "Demande à {n}"),
    "es": ("No", "Sí", "Nada", "Nada de nada", "Ninguno", "Nadie", "Está vacío", "Nunca", "Bien", "Pregunta a {n}"),
    "it": ("No", "Sì", "Niente", "Nessuno", "Mai"),
    "pt": ("Não", "Sim", "Nada", "Ninguém", "Nunca"),
    "nl": ("Nee", "Ja", "Niets", "Niemand", "Nooit"),
    "ru": ("Нет", "Да", "Ничего", "Совсем ничего", "Никто", "Там пусто", "Никогда", "Хорошо"),
    "ja": ("いいえ", "はい", "うん", "そう", "何もない", "空だった", "誰も", "はい、どうぞ"),
    "zh": ("不", "是", "对", "不是", "嗯", "会的", "什么都没有", "没有人", "好的"),
    "ko": ("아니요", "네", "아무것도", "좋아요"),
}


def stand_in(rng: random.Random) -> str:
    """A message that stands for "nothing"."""
    if rng.random() < 0.2:
        return rng.choice(MARKS)
    lang = "en" if rng.random() < 0.5 else rng.choice(list(ABSENT))
    said = rng.choice(ABSENT[lang]) if rng.random() < 0.55 else rng.choice(OF_ANSWER[lang]).format(a=rng.choice(ANSWER[lang]))
    said = rng.choice((str.lower, str.lower, str.upper, str.title, str.capitalize, lambda s: s))(said)
    if rng.random() < 0.15 and lang not in SPACELESS:
        said = said.replace(" ", rng.choice(("_", "-", "")))
    left, right = rng.choice(AROUND)
    return left + said + right


def short_reply(rng: random.Random, names: list[str]) -> str:
    """A short answer of a speaker, as a sentence with its mark."""
    lang = "en" if rng.random() < 0.5 else rng.choice(list(SHORT))
    said = rng.choice(SHORT[lang]).format(n=rng.choice(names or ["Sam"]))
    return said + ("" if rng.random() < 0.15 else rng.choice("。！") if lang in SPACELESS else rng.choice("....!?…"))
