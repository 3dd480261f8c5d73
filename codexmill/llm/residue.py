"""Problem 2: template residue, filler and error pages in place of content.

Character n-gram models are fitted for filler, placeholders, error messages and
script notices (from a grammar of how such things are worded in eight languages
and how templates mark variables) and for prose (from the counts of all texts of
the corpus but those that recur). The log likelihood ratio of each place in a
text is summed over windows; the best windows localise the residue, and a text is
excluded where residue covers it or where a window is too strong for a mere
mention of such things.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.neardup import leaves
from codexmill.llm.vectext import BMP, M1, codes, mix, portions, table_sum, tables

ORDERS = (6, 4, 3, 2)
MOST = {6: 4.0, 4: 3.0, 3: 1.5, 2: 0.7}  # nats that an n-gram may add: a short one says little,
MOST_WIDE = {6: 4.0, 4: 4.0, 3: 4.0, 2: 2.5}  # but more where it begins with an ideograph, kana or syllable
BITS = 18
WIDE = 0x3040  # the first code point of kana, ideographs and syllables
HEAVY = 2.0**-16  # share of all texts from which one that recurs is no prose
FLOOR = 3e-6  # share of n-grams up to which one counts as unseen
PRESENT = 2.0  # times the even share that an n-gram of the grammar has in residue
DROP = 14.0  # fall of the running score that ends a window
STRONG = 48.0  # score of a window that is more than a mention
CLEAR = 16.0  # score of a window that stands apart from the text around it
WHOLE = 9.0  # score of windows that cover a text, or of one that holds the marks of a template
DENSE = 0.8  # score for each character of a text that windows cover, or of a window that stands apart
SHORT = 5.0  # score of windows that cover a text to its ends
SPARSE = 0.25  # score for each character of a text that windows cover to its ends
NEAR = 12.0  # score that a dense window gains in SPAN characters
COVER = 0.5  # share of a text that residue has to cover
LEAST = 4.5  # score of a window
SPAN = 24  # characters in which a window gains its first LEAST

# The grammar of residue. A line is a row of slots in brackets; the strings of a slot stand for one another, a slot that
# begins with | may be empty.
FILLER = """
(lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. |ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. |duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. |excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum. |vitae elit purus quam pellentesque vestibulum |blindtext |praesent maecenas suspendisse tincidunt )
(tbd|tba|todo|todo: |fixme|n/a|null|null null|none|undefined|nan|[object object]|untitled|untitled document|asdf asdf|qwerty|qwer asdf|xxx|xxxxx|xxxxx xxxxx|foo bar baz|blah blah blah|test test test|text text text|-----|.....|???|abc123|to be announced|to be confirmed|coming soon|work in progress|watch this space)
(no|no further|there is no|there is currently no|currently no|we have no) (description|summary|synopsis|content|text|title|overview|information|details|blurb|introduction) (available|yet|provided|given|found|here|for this book|for this title|for this item|at this time|has been added yet|was entered)(|.)
(description|summary|synopsis|content|text|title|overview|information|blurb|more details) (coming soon|to follow|to be added|to be announced|goes here|not available|not provided|is missing|pending|will be added later|will follow shortly|to be written|unavailable|will appear here)(|.)
(please |)(enter|insert|type|write|add|put|paste|provide|replace) (your|the|a|some|this) (text|title|description|summary|name|content|short description|book description|synopsis|placeholder) (here|below|in this field|before publishing|before release|with real text|later)(|.)
(sample|example|dummy|placeholder|default|filler|test|temporary) (text|title|description|content|entry|summary|data|item|copy|record|product|paragraph) (|here|only|for layout|for item |for testing|number |, please ignore|- do not publish|to be replaced)
(this page|this space|this field|this section) (intentionally left blank|left blank on purpose|is reserved|is a placeholder|will be filled later|to be completed)
(暂无|尚无|没有|还没有|未填写|缺少|未提供|无)(简介|内容|介绍|描述|标题|信息|内容简介|作品简介|文字说明|数据)(。|，敬请期待|，请稍后补充|可显示)
(简介|内容|描述|标题|内容简介|作品介绍|正文)(待补充|待更新|待定|整理中|即将上线|敬请期待|尚未填写|稍后补充|编写中|更新中|为空)
(请|请在此|请在这里|在此处|此处|这里|此处应)(填写|输入|插入|添加|替换为|放置|写|是)(简介|内容|标题|描述|文字|作品简介|书名|作者|内容简介|文本)(这里|（不少于|不少于|个字|）|。)
(作者|该作者|编辑|管理员)(很懒|很忙|太忙|太懒|还没有)(，还没|，什么都|，尚未|，没有|来得及)(写简介|留下|没有留下|填写任何内容|写下任何介绍|添加简介|来得及写)
(测试|示例|占位|样例|默认|演示|临时)(文本|文字|标题|数据|内容|描述|简介|商品|条目|用)(测试|，请忽略|，勿删|一二三|)
(説明|あらすじ|紹介文|内容|概要|作品情報|タイトル|本文)(は|が|を)(準備中です|ありません|まだありません|登録されていません|未入力です|入力してください|近日公開|ただいま準備中|後日掲載します|未設定です|追加される予定です)
(ここに|こちらに)(テキスト|タイトル|説明|あらすじ|文章|本文|紹介文|作品名)(を入力してください|を入力|が入ります|を書いてください|を挿入|を記入してください|が表示されます)
(サンプル|ダミー|テスト|仮の)(テキスト|テスト|文章|データ|タイトル|説明文|です)(|です|になります|。)
(설명|소개|줄거리|내용|제목|작품 소개|요약)(이|가|은|는|을|를| ) (없습니다|준비 중입니다|아직 없습니다|등록되지 않았습니다|입력하세요|곧 공개됩니다|입력되지 않았습니다|추가될 예정입니다|작성해 주세요|미정)
(여기에|이곳에) (설명|제목|텍스트|내용|소개|줄거리|글)(을|를) (입력하세요|입력해 주세요|넣으세요|작성하세요|추가하세요)
(샘플|테스트|예시|더미|임시) (텍스트|테스트|데이터|제목|내용|설명|문구)(|입니다)
(beschreibung|inhaltsangabe|text|titel|inhalt|zusammenfassung|klappentext|weitere angaben) (folgt in kürze|folgt|fehlt|fehlt noch|noch nicht vorhanden|wird nachgereicht|in vorbereitung|nicht verfügbar|kommt bald|wird später ergänzt|liegt noch nicht vor)(|.)
(keine|noch keine|es gibt keine|derzeit keine) (beschreibung|inhaltsangabe|angaben|informationen|zusammenfassung) (vorhanden|verfügbar|hinterlegt|eingetragen|erfasst)(|.)
(hier |bitte hier |bitte )(text|titel|beschreibung|inhalt|den text|einen titel|eine beschreibung) (eingeben|einfügen|eintragen|einsetzen|ergänzen)(|.)
(beispieltext|platzhalter|platzhaltertext|mustertext|blindtext|testeintrag|dummytext|fülltext|nur ein test)
(description|résumé|texte|titre|contenu|synopsis|présentation) (à venir|à définir|à compléter|manquant|indisponible|non disponible|bientôt disponible|en cours de rédaction|non renseigné|pas encore disponible|sera ajouté plus tard)(|.)
(aucune|aucun|pas encore de|pas de) (description|résumé|contenu|texte|information|présentation) (disponible|renseigné|fourni|pour le moment|pour l'instant|n'a été saisi)(|.)
(saisissez|saisir|entrez|insérez|écrivez|ajoutez|veuillez saisir) (votre|le|un|ici votre|la) (texte|titre|description|résumé|contenu) (ici|ci-dessous|à cet endroit)(|.)
(texte|contenu|titre|description) (d’exemple|d'exemple|de test|de remplissage|par défaut|provisoire|factice)
(descripción|resumen|sinopsis|texto|título|contenido) (no disponible|próximamente|pendiente|por definir|en preparación|aún no disponible|por completar|se añadirá pronto|vacío)(|.)
(sin|sin ninguna|no hay|todavía no hay|aún no hay) (descripción|resumen|sinopsis|contenido|texto|información) (disponible|por ahora|para este libro|todavía)(|.)
(introduzca|escriba|inserte|ingrese|añada|escribe) (el texto|su texto|aquí su|el título|aquí el|la descripción|un resumen|tu texto) (aquí|en este campo|a continuación|)(|.)
(texto|título|contenido) (de ejemplo|de prueba|de relleno|provisional|predeterminado)
(описание|аннотация|текст|название|содержание|информация) (отсутствует|скоро появится|будет добавлено позже|не указано|не заполнено|пока нет|готовится|в разработке|недоступно|появится позднее)(|.)
(нет|пока нет|здесь пока нет|ещё нет) (описания|аннотации|текста|содержания|данных|информации)(|.)
(введите|вставьте|напишите|добавьте|укажите|заполните) (текст|описание|название|аннотацию|ваш текст|заголовок) (здесь|сюда|в этом поле|)(|.)
(пример|образец|здесь будет|тут будет|тестовый|текст-|тестовое) (текста|текст|описание|описания|заполнитель|название|заголовок)
"""
ERRORS = """
(error|error code|http|http error|status|http/1.1|) (400|401|402|403|404|405|408|409|410|418|429|500|501|502|503|504|521|522|) (not found|forbidden|bad request|unauthorized|internal server error|bad gateway|service unavailable|gateway timeout|gone|too many requests|request timeout|i'm a teapot|method not allowed|payment required|conflict|: page not found|web server is down|connection timed out)(|.)
(the requested |this |the |that |your requested |our )(page|url|file|resource|document|site|article|book|content|item|link|listing|entry|record|website|server) (was not found|could not be found|cannot be found|does not exist|doesn't exist|no longer exists|is not available|is no longer available|is unavailable|is currently unavailable|was removed|has been removed|has been deleted|has expired|has moved|could not be loaded|failed to load|cannot be displayed|could not be displayed|is down for maintenance|is not responding|is not available in your country|isn't available in your region|is temporarily down|took too long to respond|you are looking for does not exist)( on this server|)(|.)
(sorry, |oops! |we're sorry, |we are sorry, |uh oh, |)(something went wrong|an error occurred|an error has occurred|an unexpected error occurred|a problem occurred|we couldn't find|we could not find|we can't find|we encountered an error|we hit a snag|nothing was found|that didn't work) (while processing your request|on our end|that page|the page you requested|what you were looking for|while loading this page|. ref|. reference number|. please refresh the page|, try reloading)(|.)
(access|permission|entry|connection|request|session|login|token|transaction) (denied|refused|timed out|expired|was denied|has expired|was reset|is forbidden|failed|blocked|rejected|lost|was interrupted|terminated)(|.)(| please log in again| reference number| by peer| to view this page)
(you do not have|you don't have|insufficient) (permission|permissions|access|rights|sufficient privileges) (to view|to access|to open|to read) (this page|this content|this resource|on this server)(|.)
(please |)(try again|try again later|retry|retry after|reload the page|refresh the page|check your connection|contact the administrator|contact support|come back later|check the url) (later|in a few minutes|seconds|in a moment|if the problem persists|and try again|shortly|soon)(|.)
(too many|rate limit|quota|request limit|usage limit) (requests|exceeded|attempts|reached|connections|from your network)(|.)
(service|site|server|website|the system|our site|scheduled|this service) (temporarily unavailable|under maintenance|maintenance|is offline|maintenance in progress|maintenance until|overloaded|busy|is undergoing maintenance|down for maintenance|unavailable|will be back soon|is being upgraded)(|.)
(we'll|we will|we’ll) (be back soon|be right back|return shortly|be back shortly)(|.|!)
(traceback (most recent call last):|file ".py", line |, in |keyerror: |valueerror: |typeerror: |attributeerror: |nameerror: |referenceerror: |syntaxerror: |uncaught |unhandled exception: |cannot read properties of |cannot read property | of undefined|is not a function|is not defined|nonetype' object has no attribute |java.lang.nullpointerexception|java.lang.illegalstateexception| at com.example.|exception in thread "main" |.java:|segmentation fault (core dumped)|stack trace:|panic: runtime error|fatal error: |uncaught exception|warning: |notice: |undefined index: |undefined variable: |on line |mysql_connect(): |sqlstate[|ora-|connection to database failed|database error|error establishing a database connection|syntax error near|parse error: |unexpected token|errno |enoent: no such file or directory|err_connection_refused|err_name_not_resolved|dns_probe_finished_nxdomain|ssl handshake failed)
(页面|网页|该页面|您访问的页面|你访问的页面|内容|该内容|文章|本文|资源|链接|该作品|请求的网页|文件|此页)(不存在|已被删除|已删除|无法访问|找不到了|未找到|已下架|无法显示|已失效|加载失败|走丢了|暂时无法访问|不见了|已过期|无法打开|可能已被移除|或已被删除|已被移动)(。|（错误码：|，请稍后再试|，请返回首页|，错误代码|）)
(抱歉，|对不起，|很抱歉，|糟糕，)(您访问的页面|你要找的页面|您没有权限|出错了|服务器|该内容|找不到|系统|无法)(不存在|查看此页面|访问|开小差了|出现错误|打开该页面|找到您要的内容|暂时无法显示)
(服务器|系统|网络|网络连接|内部服务器|数据库|请求|连接|网站|访问|程序)(繁忙|错误|异常|超时|维护中|出错|连接失败|被拒绝|过于频繁|无响应|失败|升级中|中断|开小差了|发生未知错误|正在维护|拒绝了请求)(，请稍后再试|，请稍后重试|，点击重试|。|，请刷新|，请联系管理员)
(没有权限|您没有权限|无权|您无权|拒绝|禁止)(查看|访问|浏览|打开|阅读)(此页面|该页面|本站|此内容|该资源)
(加载|读取|获取|下载)(失败|出错|超时|数据失败)(，请|，点击)(刷新重试|刷新页面|稍后再试|重试|重新加载)
(お探しの|ご指定の|要求された|この|リクエストされた|該当の|アクセスしようとした)(ページ|記事|コンテンツ|ファイル|作品|サイト|url|情報)(は|が)(見つかりません|見つかりませんでした|存在しません|削除されました|削除された可能性があります|現在利用できません|表示できません|移動しました|公開されていません|ご利用いただけません|終了しました)(|。|（)
(サーバー|サーバ|システム|内部|通信|ネットワーク|データベース|接続|読み込み|予期しない|不明な)(エラー|障害|エラーが発生しました|に接続できません|が混み合っています|に失敗しました|がタイムアウトしました|の応答がありません|メンテナンス中です|に問題が発生しました)(|。)
(アクセスが|リクエストが|現在アクセスが|通信が)(集中しています|拒否されました|多すぎます|禁止されています|混雑しています|制限されています|切断されました)(|。)
(しばらくしてから|時間をおいて|しばらく経ってから|のちほど|後ほど)(再度お試しください|もう一度お試しください|アクセスしてください|やり直してください|再読み込みしてください)(|。)
(閲覧する|アクセスする|表示する)(権限がありません|には権限が必要です|ことができません)
(요청하신|찾으시는|해당|이|방문하신) (페이지|글|콘텐츠|게시물|파일|자료|작품|주소)(를|을|는|은|가|이) (찾을 수 없습니다|존재하지 않습니다|삭제되었습니다|이용할 수 없습니다|표시할 수 없습니다|불러올 수 없습니다|이동되었습니다|더 이상 제공되지 않습니다)(|.)
(서버|내부 서버|시스템|네트워크|데이터베이스|연결|알 수 없는|일시적인) (오류|오류가 발생했습니다|점검 중입니다|장애가 발생했습니다|연결에 실패했습니다|시간이 초과되었습니다|응답이 없습니다|문제가 발생했습니다)(|.)
(잠시 후|나중에|잠시 뒤|조금 뒤에) (다시 시도해 주세요|다시 시도하세요|다시 접속해 주세요|다시 이용해 주세요)(|.)
(접근이|접속이|요청이|권한이|서비스가|세션이) (거부되었습니다|차단되었습니다|너무 많습니다|없습니다|중단되었습니다|만료되었습니다|제한되었습니다|점검 중입니다)(|.)
(fehler|fehler 404|http-fehler|interner fehler|interner serverfehler|serverfehler|fehlercode)(|: | – )(seite nicht gefunden|zugriff verweigert|zeitüberschreitung|nicht gefunden|dienst nicht verfügbar|ungültige anfrage)(|.)
(die |diese |der |dieser |das |dieses )(angeforderte |gesuchte |gewünschte |)(seite|datei|inhalt|artikel|dokument|buch|dienst|server|website|eintrag|verbindung|sitzung) (wurde nicht gefunden|konnte nicht gefunden werden|existiert nicht|existiert nicht mehr|existiert leider nicht|ist nicht verfügbar|ist vorübergehend nicht verfügbar|wurde gelöscht|wurde entfernt|konnte nicht geladen werden|ist abgelaufen|antwortet nicht|ist leider nicht mehr verfügbar|kann nicht angezeigt werden|wird gewartet|ist nicht erreichbar)(|.)
(bitte |)(versuchen sie es|versuche es|probieren sie es|laden sie die seite) (später erneut|später noch einmal|in kürze erneut|noch einmal|neu)(|.)
(zugriff|zugang|anfrage|verbindung|anmeldung) (verweigert|gesperrt|abgelehnt|fehlgeschlagen|unterbrochen|nicht gestattet)(|.)
(es ist ein|ein unerwarteter|leider ist ein) (fehler|interner fehler|problem) (aufgetreten|ist aufgetreten)(|.)
(page|cette page|la page|la page demandée|ce contenu|le fichier|l'article|le document|ce livre|le site|le serveur|le service|cet ouvrage) (introuvable|n'existe pas|n’existe plus|n'existe plus|est introuvable|n'est pas disponible|n’est pas disponible|a été supprimé|a été supprimée|est temporairement indisponible|ne peut être affiché|ne répond pas|est en maintenance|a été déplacée|est actuellement inaccessible|n'a pas pu être chargée)(|.)( (erreur 404)|)
(erreur|erreur 404|erreur 500|erreur interne|une erreur|une erreur inattendue) (interne du serveur|est survenue|s'est produite|: page introuvable|de connexion|du serveur|de chargement|de base de données)(|.)
(accès|connexion|requête|session) (refusé|interdit|expirée|refusée|impossible|rejetée|interrompue)(|.)
(veuillez|merci de) (réessayer|réessayer plus tard|réessayer ultérieurement|recharger la page|revenir plus tard|vous reconnecter)(|.)
(la página|esta página|el contenido|este contenido|el archivo|el artículo|el libro|el servidor|el sitio|el servicio|el documento|la página solicitada|página) (no existe|ya no existe|no encontrada|no fue encontrada|no está disponible|ha sido eliminado|ha sido eliminada|no responde|no se pudo cargar|no se puede mostrar|está en mantenimiento|fue eliminado|se ha movido|no se encuentra disponible|no se ha encontrado)(|.)( (error 404)|)
(error|error 404|error 500|error 504|error interno|se ha producido un error|ha ocurrido un error|ocurrió un error) (interno del servidor|del servidor|de conexión|: página no encontrada|inesperado|de base de datos|al cargar la página|al procesar la solicitud)(|.)
(acceso|conexión|solicitud|sesión) (denegado|rechazada|caducada|prohibido|denegada|restringido|perdida)(|.)
(inténtelo|inténtalo|intente|vuelva a intentarlo|por favor, intente) (de nuevo más tarde|más tarde|de nuevo|nuevamente|en unos minutos)(|.)
(servicio|sitio) (no disponible|temporalmente fuera de servicio|en mantenimiento|no disponible temporalmente)(|.)
(страница|эта страница|запрашиваемая страница|файл|материал|сайт|сервис|сервер|ресурс|книга|статья|документ|содержимое) (не найдена|не найден|не существует|больше не существует|была удалена|был удалён|удалена|временно недоступен|временно недоступна|недоступен|недоступна|не отвечает|не может быть отображена|на техническом обслуживании|перемещена|не загрузилась|удалено)(|.)
(ошибка|ошибка 404|внутренняя ошибка|произошла ошибка|ошибка сервера|неизвестная ошибка) (сервера|страница не найдена|соединения|базы данных|при загрузке страницы|. страница не найдена|при обработке запроса)(|.)
(доступ|соединение|запрос|сессия|вход) (запрещён|запрещен|отклонён|прервано|отклонен|истекла|ограничен|заблокирован|закрыт)(|.)
(попробуйте|пожалуйста, попробуйте|повторите попытку|обновите страницу|зайдите) (позже|ещё раз|снова|через несколько минут|или попробуйте позже)(|.)
(слишком много|превышен лимит|ведутся|проводятся) (запросов|технические работы|подключений|попыток)(|.)
"""
NOTICES = """
(please |you need to |you must |)(enable|turn on|allow|activate|switch on|re-enable) (javascript|cookies|scripts|scripting|scripts and cookies|javascript and cookies|javascript in your browser) (to view this content|to view this page|to continue|to run this app|in your browser|to read this book|and reload the page|to proceed|to use this site|for full functionality|to see the text|and refresh)(|.)
(javascript|scripting|cookies) (is disabled|is turned off|is required|are required|must be enabled|is not enabled|are disabled|is switched off) (in your browser|to view this page|. reload after|on your device|for this site|to read on)(|.)
(<noscript>|</noscript>|)(this page|this site|this app|this reader|this website|our reader) (requires javascript|requires scripting|needs javascript|works best with javascript|doesn't work without javascript|relies on scripts|requires cookies)(|.|.</noscript>)
(checking|verifying|we are checking|please wait while we check) (your browser|that you are human|you are human|if the site connection is secure|your connection|your request) (before accessing|before you proceed|. this may take a few seconds|. please wait|before continuing)(|.|...)
(just a moment|one moment please|hold on|please wait)(...|, )(verifying|redirecting|checking|loading|we are verifying you)
(please |)(verify|confirm|prove|solve|pass) (you are a human|you are not a robot|that you are human|the captcha|the security check|the challenge below) (to continue|to proceed|to access this page|before viewing)(|.)
(your browser|this browser|your version of the browser) (is not supported|is out of date|is outdated|does not support javascript|does not support scripts|is no longer supported|is too old)(|.)(| please upgrade| please update your browser| please switch)
(ddos protection by |ray id: |performance & security by |enable cookies and reload the page|i'm not a robot|captcha required|unusual traffic from your network)
(您的|请|请先|请在|本页面|本站|你的|当前)(浏览器|启用|开启|允许|需要|打开)(javascript|脚本|cookie|js|禁用了脚本|中启用|版本过低|不支持脚本|未开启)(后刷新页面|，无法显示正文|后重试|才能继续|以继续|才能阅读|后再访问|，请升级|功能|支持|中的)
(正在|系统正在|我们正在)(检查|验证|检测|确认)(您的浏览器|您是否为真人|浏览器环境|访问安全性|您的身份|连接是否安全)(，请稍候|……|。)
(请|需要)(完成|输入|通过|进行)(安全验证|验证码|人机验证|身份验证|滑块验证)(后继续|以继续访问|后访问|才能继续)
(この|当|本)(ページ|サイト|リーダー|アプリ)(を|は)(表示する|見る|利用する|閲覧する|ご利用になる)(には|ために)(javascript|クッキー|cookie|スクリプト)(を有効にしてください|が必要です|を許可してください|を有効にする必要があります|をオンにしてください)(|。)
(ブラウザ|お使いのブラウザ|ご利用のブラウザ)(の|は|を|で)(javascriptを有効にしてください|サポートされていません|確認しています|対応していません|設定を確認してください|javascriptが無効です|更新してください|スクリプトが無効になっています)(|。)
(あなたが|ロボットでは|人間で)(人間であること|ないこと|あることを)(を確認しています|を証明してください|確認してください)
(이 페이지|이 사이트|본문|콘텐츠|본 서비스)(를|을) (보려면|이용하려면|읽으려면|표시하려면|계속하려면) (javascript|쿠키|스크립트|자바스크립트)(를|를 |가 )(활성화하세요|활성화해 주세요|사용하도록 설정하세요|허용해 주세요|켜 주세요|필요합니다)(|.)
(브라우저|사용 중인 브라우저|브라우저에서) (를|에서|가|는|javascript를) (확인하는 중입니다|지원되지 않습니다|사용하도록 설정하세요|활성화하세요|최신 버전이 아닙니다|비활성화되어 있습니다|업데이트해 주세요)(|.)
(쿠키를|스크립트를|보안 문자를|사람인지) (허용해 주세요|사용해야 합니다|입력해 주세요|확인하는 중입니다|켜야 합니다)
(bitte |sie müssen |)(aktivieren sie|erlauben sie|schalten sie|lassen sie) (javascript|cookies|skripte|scripts)(, um | ein, um | in ihrem browser|, damit )(fortzufahren|die seite anzuzeigen|diesen inhalt zu sehen|weiterzulesen|zu gelangen|der text erscheint)(|.)
(ihr browser|ihr gerät|dieser browser) (wird überprüft|unterstützt kein javascript|wird nicht unterstützt|ist veraltet|blockiert skripte|hat javascript deaktiviert)(|.)
(diese seite|diese anwendung|zum lesen) (benötigt|erfordert|braucht|wird benötigt) (javascript|cookies|aktive skripte)(|.)
(veuillez |merci d'|vous devez )(activer|autoriser|accepter) (javascript|les cookies|les scripts)( pour | dans votre )(lire cette page|continuer|afficher ce contenu|navigateur|accéder au site|poursuivre)(|.)
(vérification|contrôle) (de votre navigateur|que vous êtes humain|de sécurité en cours)(|.)
(javascript|votre navigateur|ce site) (est désactivé|n'est pas pris en charge|nécessite javascript|est obsolète|a besoin de javascript) (dans votre navigateur|pour fonctionner)(|.)
(active|habilite|activa|permita|debe activar|necesita activar) (javascript|las cookies|los scripts)( en su navegador| para )(para continuar|continuar|ver esta página|leer este contenido|mostrar el texto)(|.)
(comprobando|verificando|estamos comprobando) (su navegador|que es humano|la conexión|su identidad)(|.)
(javascript|su navegador|este sitio) (está desactivado|no es compatible|requiere javascript|necesita javascript|está obsoleto) (en su navegador|para funcionar)(|.)
(для просмотра|чтобы продолжить|для чтения|для работы сайта) (включите|необходимо включить|разрешите|требуется|нужен) (javascript|cookies|скрипты|файлы cookie)( в браузере| и обновите страницу|)(|.)
(проверка|идёт проверка|проверяем|подтвердите, что) (вашего браузера|браузера|вы не робот|ваш браузер|что вы человек)(|.)
(javascript|ваш браузер|скрипты) (отключён|отключен|отключены|не поддерживается|устарел|выключены) (в вашем браузере|в браузере)(|.)
"""
# Words that names of variables are made of, and ways to mark a variable; X stands for its name.
VARIABLES = """title name author summary description text body label content blurb synopsis isbn volume chapter series date price user item product book page meta locale lang count
key value url id image tag category publisher vendor year first last short long placeholder desc vol num ref slug intro tagline 标题 书名 作者 简介 内容 作品简介 タイトル 作者名 あらすじ 제목 저자 소개 titre titel autor título название автор описание""".split()
JOINTS = (".", "_", "-", " ")
MARKUP = """{{X}}|{{ X }}|{{{X}}}|${X}|#{X}|<%= X %>|<% X %>|{% block X %}|{% endblock %}|{% X %}|{% if X %}|%X%|%%X%%|[[X]]|__X__|@@X@@|<X>|&lt;X&gt;|{0:X}|{X}|【请填写X】|【X】|〈X〉|{0}|%s|%1$s|%d|[INSERT X HERE]|[Insert X]|[X here]|<insert X>|(X here)|$X$|##X##|[your X here]|YOUR_X_HERE|{{ X | default }}|<?php echo X ?>|<?= X ?>""".split("|")


def slots_of(line: str) -> list[list[str]]:
    """The slots of a line of the grammar; what stands between two belongs to the one before."""
    out, depth, begin = [], 0, 0
    for i, c in enumerate(line):
        if c == "(":
            depth += 1
            begin = i + 1 if depth == 1 else begin
        elif c == ")":
            depth -= 1
            if not depth:
                out.append(line[begin:i].split("|"))
        elif not depth:
            out[-1] = [x + c for x in out[-1]]
    return out


def strings() -> list[str]:
    """Strings that together hold every n-gram of the grammar and of marked variables; a line end closes what closes a text."""
    out = []
    for line in (x for block in (FILLER, ERRORS, NOTICES) for x in block.strip().split("\n")):
        slots = slots_of(line)
        slots[-1] = [x + "\n" for x in slots[-1]]
        if len(slots) == 1:
            out += slots[0]
        # n-grams reach over a slot only where its string is short
        out += [x + y for a, b in zip(slots, slots[1:], strict=False) for x in a for y in b]
        out += [x + y + z for a, b, c in zip(slots, slots[1:], slots[2:], strict=False) for y in b if len(y) < ORDERS[0] - 1 for x in a for z in c]
    names = [*VARIABLES, *(a + j + b for a, b in zip(VARIABLES, VARIABLES[1:], strict=False) if a.isascii() and b.isascii() for j in JOINTS)]
    return out + [w.replace("X", n) + end for n in names for w in MARKUP for end in ("", "\n")]


def grams(low: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the n-grams that begin at each place of a folded text, for n up to the longest order; None for others."""
    h = np.zeros(len(low), np.uint64)
    for n in range(1, ORDERS[0] + 1):
        if len(low) < n:
            return
        h = h[: len(low) - n + 1] * M1 + low[n - 1 :] + np.uint64(1)
        if n in ORDERS:
            yield mix(h)


def slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def marks(h: np.ndarray) -> np.ndarray:
    """A second hash of 16 bits, by which an n-gram in a slot is told from another."""
    return h.astype(np.uint16)


def folded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw, at = codes(texts)
    low = np.minimum(raw, BMP)
    low = np.where(low < BMP, tables()[1][low], BMP)
    return np.where((low >= 48) & (low < 58), 48, low).astype(np.uint64), at


def known_grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct n-grams of texts and the most that each may add, for each order from the shortest; none reaches from one text into the next."""
    low, at = folded(texts)
    room = np.repeat(at[1:], np.diff(at)) - np.arange(len(low))
    orders = sorted(ORDERS)
    out = []
    for n, h in zip(orders, grams(low), strict=False):
        own, at = np.unique(np.where(room[: len(h)] >= n, h, 0), return_index=True)
        out.append((own[own > 0], np.where(low[at] >= WIDE, MOST_WIDE[n], MOST[n])[own > 0]))
    return out


@lru_cache(maxsize=1)
def grammar_grams() -> list[tuple[np.ndarray, np.ndarray]]:
    return known_grams(strings())


def tally(table: np.ndarray, texts: list[str]) -> None:
    """Add the n-grams of texts to a table of counters, order after order."""
    for part in portions(texts):
        low, at = folded([t + "\n" for t in texts[part]])
        whole, hashes = np.ones(len(low), bool), grams(low)
        for n in range(1, ORDERS[0]):
            # the n-gram that begins so near to an end reaches into the next text
            whole[np.maximum(at[1:] - n, 0)] = False
            if n + 1 in ORDERS and len(low) > n:
                k = ORDERS[::-1].index(n + 1)
                h = next(hashes)
                table[k << BITS : k + 1 << BITS] += np.bincount(slots(h[whole[: len(h)]]), minlength=1 << BITS)


FIELDS = ("title", "summary", "description")


def raw_texts(localizations: DataFrame) -> DataFrame:
    """The texts of all deliveries as stored, each with a hash."""
    return localizations.where("locId is not null").select("locId", F.struct("capturedAt", "updatedAt").alias("late"), *FIELDS, *[F.xxhash64(c).alias(f"hash_{c}") for c in FIELDS])


def recurring(raw: DataFrame) -> np.ndarray:
    """Hashes of the texts that make up more than a share ``HEAVY`` of all, of which there can't be more than its inverse."""
    each = raw.select(F.explode(F.array(*[F.when(F.col(c) != "", F.col(f"hash_{c}")) for c in FIELDS])).alias("h")).where("h is not null")
    # the sum over all reads the same shuffle as the counts
    found = raw.sparkSession.sql("SELECT h FROM {counts} WHERE n >= greatest(3, {heavy} * (SELECT sum(n) FROM {counts}))", counts=each.groupBy("h").agg(F.count("*").alias("n")), heavy=HEAVY)
    return np.sort(found.toArrow()["h"].to_numpy().astype(np.int64))


def texts_of(batch: pa.RecordBatch, first: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(texts, row of each, field of each): what is not null or empty in three columns from ``first``, of descriptions the text inside."""
    out, rows, names = [], [], []
    for k in range(3):
        for i, t in enumerate(batch.column(first + k).to_pylist()):
            if t and (t := leaves(t) if k == 2 else t):
                out.append(t)
                rows.append(i)
                names.append(k)
    return out, np.array(rows, np.int64), np.array(names, np.int64)


def prose_counts(raw: DataFrame, heavy: np.ndarray) -> np.ndarray:
    """Counts of the n-grams of all texts but the recurring ones, so that no filler that many rows carry passes for prose."""

    def count(table: np.ndarray, batch: pa.RecordBatch) -> None:
        texts, rows, names = texts_of(batch, 0)
        if texts:
            h = np.stack([batch.column(3 + k).to_numpy() for k in range(3)])[names, rows]
            tally(table, [t for t, often in zip(texts, np.isin(h, heavy).tolist(), strict=True) if not often])

    table = table_sum(raw.select(*FIELDS, *[f"hash_{c}" for c in FIELDS]), len(ORDERS) << BITS, count)
    return table.reshape(len(ORDERS), 1 << BITS)


class Ratio:
    """Log likelihood ratios, residue against prose, as float32 tables of fixed size; orders from the shortest."""

    def __init__(self, residue: list[tuple[np.ndarray, np.ndarray]], prose: np.ndarray):
        self.tables = []
        for (h, most), q in zip(residue, prose, strict=True):
            at = slots(h)
            which, own, cap = np.zeros(1 << BITS, np.uint16), np.zeros(1 << BITS, bool), np.zeros(1 << BITS)
            which[at], own[at], cap[at] = marks(h), True, most
            # the rarest n-grams are no wording of prose, as residue itself is part of the corpus
            p = np.maximum(q / max(1, q.sum()), FLOOR)
            hit = np.log((PRESENT / max(1, len(h)) + FLOOR) / p).clip(-4, cap)
            miss = np.log(FLOOR / p).clip(-4, -0.7)
            # slots are shared by rare n-grams, so only a frequent one is known from prose
            frequent = q > 5 * FLOOR * q.sum()
            # all that is known of a slot side by side, so that one look tells it
            row = np.zeros((1 << BITS, 4), np.uint16)
            row[:, 0], row[:, 1], row[:, 2], row[:, 3] = which, own | frequent.astype(np.uint16) << 1, hit.astype(np.float16).view(np.uint16), miss.astype(np.float16).view(np.uint16)
            self.tables.append(row.view(np.uint64)[:, 0])

    def places(self, low: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The ratio at each place, of the longest n-gram there that either model knows; n-grams don't cross texts."""
        out = np.full(len(low), -0.7, np.float16)
        inside = np.ones(len(low), bool)
        ends = at[1:] - 1
        reach = 1
        for n, h, table in zip(sorted(ORDERS), grams(low), self.tables, strict=False):
            for k in range(reach, n):
                inside[np.maximum(ends - k + 1, 0)] = False  # an n-gram that begins here ends in the next text
            reach = n
            row = table.take(slots(h)).view(np.uint16).reshape(-1, 4)
            own = (row[:, 0] == marks(h)) & ((row[:, 1] & 1) > 0) & inside[: len(h)]
            np.copyto(out[: len(h)], row[:, 3].view(np.float16), where=~own & (row[:, 1] > 1) & inside[: len(h)])
            np.copyto(out[: len(h)], row[:, 2].view(np.float16), where=own)
        return out.astype(np.float32)


def windows(x: np.ndarray) -> list[tuple[int, int, float]]:
    """(begin, end, score) of the windows with the greatest sums, from left to right."""
    c = np.cumsum(np.maximum(x, 0), dtype=np.float64)
    rise = c.copy()
    rise[SPAN:] -= c[:-SPAN]
    near = np.flatnonzero(rise >= LEAST)
    if not len(near):
        return []
    # only around places where a window gains enough does the running score have to be followed
    cut = np.flatnonzero(np.diff(near) > 3 * SPAN)
    begins, ends = near[np.append(0, cut + 1)] - SPAN, near[np.append(cut, len(near) - 1)] + 1
    out: list[tuple[int, int, float]] = []
    for a, b in zip(np.maximum(begins, 0).tolist(), ends.tolist(), strict=True):
        out += [(a + u, a + v, s) for u, v, s in _sums(x[a : b + SPAN].tolist())]
    return out


def _sums(x: list[float]) -> list[tuple[int, int, float]]:
    out, s, peak, begin, end = [], 0.0, 0.0, 0, 0
    for i, v in enumerate(x):
        if s <= 0:
            s, peak, begin = 0.0, 0.0, i
        s += v
        if s > peak:
            peak, end = s, i + 1
        elif s < peak - DROP or s <= 0:
            if peak >= LEAST:
                out.append((begin, end, peak))
            s = 0.0
    if s > 0 and peak >= LEAST:
        out.append((begin, end, peak))
    return out


def judge(text: str, x: np.ndarray) -> list[tuple[int, int, float]]:
    """The windows of a text that are residue, empty for prose."""
    found = windows(x)
    size = len(text.strip())
    score = sum(w[2] for w in found)
    covered = sum(min(b + 2, len(text)) - a for a, b, _ in found)
    if found and covered >= COVER * size and (score >= max(WHOLE, DENSE * size) or marked(text) or covered >= 0.95 * size and score >= max(SHORT, SPARSE * size)):
        return found
    return [w for w in found if w[2] >= max(CLEAR, DENSE * (w[1] - w[0])) and (w[2] >= STRONG or set_apart(text, w[0], w[1])) or w[2] >= WHOLE and marked(text[max(0, w[0] - 2) : w[1] + 2])]


def suspects(texts: list[str], x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The texts that ``judge`` can find anything in, by bounds on what it asks for.

    A window as dense as it has to be gains more than ``NEAR`` somewhere in
    ``SPAN`` characters; a short text may also be covered more thinly, and marks
    make do with less.
    """
    gains = np.maximum(x, 0)
    y = np.concatenate([np.zeros(SPAN), np.cumsum(gains, dtype=np.float64)])
    rises = np.maximum.reduceat(y[SPAN:] - y[:-SPAN], at[:-1])
    total, size = np.add.reduceat(gains, at[:-1]), np.diff(at)
    keep = (rises >= NEAR) | (size <= 2 * NEAR / SPARSE) & (total >= np.maximum(SHORT, SPARSE * (size - 3)))
    for k in np.flatnonzero((rises >= LEAST) & ~keep).tolist():
        keep[k] = MARK.search(texts[k]) is not None
    return np.flatnonzero(keep)


def set_apart(text: str, a: int, b: int) -> bool:
    """Whether a window begins where a sentence does and doesn't run on into one."""
    while a < b and text[a].isspace():
        a += 1
    return bool(len(text[:a].strip()) < 3 or BORDER.search(text, max(0, a - 3), a)) and (bool(INSIDE.search(text, a, b)) or not RUNS_ON.match(text, b))


def marked(part: str) -> bool:
    """Whether a window holds the marks of a template, which prose that mentions one doesn't."""
    return sum(c in "{}<>%$#@_【】" for c in part) + 2 * part.count("[[") + 2 * part.count("&lt;") + 2 * part.count("[INSERT") >= 2


MARK = re.compile(r"[{}<>%$#@_【】]|\[\[|&lt;|\[INSERT")
BORDER = re.compile(r"[。.!?！？…>:：|\n」”\"]\s*\w{0,3}$")
INSIDE = re.compile(r"[。.!?！？…:：]\s")
RUNS_ON = re.compile(r"\w*[,;]?\s+[a-zà-ÿа-я]")


def residue_ids(localizations: DataFrame) -> DataFrame:
    """(locId) of the localizations with residue in any text, once each."""
    return residue(localizations).select("locId").distinct()


def fitted(raw: DataFrame) -> Ratio:
    """The models of residue and of prose, for the texts of ``raw_texts``."""
    return Ratio(grammar_grams(), prose_counts(raw, recurring(raw)))


def residue(localizations: DataFrame) -> DataFrame:
    """(locId, field, begin, end, score): windows of residue in the texts of localizations.

    Null and empty texts hold none; repeated deliveries count once, by their
    last. Texts are read whole, whatever their length. Each delivery is judged
    where it lies; only its findings are then held against the time of the
    localization's last delivery, so that no text is ever shuffled.
    """
    raw = raw_texts(localizations)
    send = localizations.sparkSession.sparkContext.broadcast(fitted(raw))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = send.value
        for batch in batches:
            texts, owners, names = texts_of(batch, 2)
            out = []
            for part in portions(texts):
                low, at = folded([t + "\n" for t in texts[part]])
                x = ratio.places(low, at)
                for k in suspects(texts[part], x, at).tolist():
                    i = part.start + k
                    out += [(owners[i], FIELDS[names[i]], a, b, s) for a, b, s in judge(texts[i], x[at[k] : at[k + 1] - 1])]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            rows = pa.array(cols[0], pa.int32())
            found = [pa.array(c, t) for c, t in zip(cols[1:], (pa.string(), pa.int32(), pa.int32(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *found], names=["locId", "late", "field", "begin", "end", "score"])

    late = raw.schema["late"].dataType.simpleString()
    found = raw.select("locId", "late", *FIELDS).mapInArrow(scan, f"locId long, late {late}, field string, begin int, end int, score double")
    last = raw.groupBy("locId").agg(F.max("late").alias("last"))
    return found.join(last, "locId").where("late <=> last").drop("late", "last").distinct()
